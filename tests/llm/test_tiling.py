import random
import re

from tidemark.llm import tiling as T


def naive_tiles(item, text, least):
    """Greedy string tiling word by word: the longest unmarked common run, again and again."""
    marked_item, marked_text, tiles = set(), set(), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(text)):
                k = 0
                while (
                    i + k < len(item)
                    and j + k < len(text)
                    and item[i + k] == text[j + k]
                    and i + k not in marked_item
                    and j + k not in marked_text
                ):
                    k += 1
                if k > best[2]:
                    best = (i, j, k)
        i, j, k = best
        if k < least or not k:
            return tiles
        tiles.append(best)
        marked_item |= set(range(i, i + k))
        marked_text |= set(range(j, j + k))


def test_tiles_equal_naive_tiling():
    rng = random.Random(8)
    for _ in range(300):
        item = [rng.randrange(rng.choice([2, 5, 50])) for _ in range(rng.randint(1, 25))]
        text = [rng.randrange(rng.choice([2, 5, 50])) for _ in range(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 4)):
            a = rng.randrange(len(item))
            at = rng.randint(0, len(text))
            text[at:at] = item[a : a + rng.randint(1, 12)]
        least = rng.randint(1, 5)
        got, expected = T.greedy_tiles(item, text, least), naive_tiles(item, text, least)
        assert sorted(got) == sorted(expected)


def wordlist(text):
    return re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(documents, items, least, min_coverage):
    out = []
    for doc_id, text in documents:
        for item_id, item in items:
            own = wordlist(item)
            if own:
                tiles = naive_tiles(own, wordlist(text), min(least, len(own)))
                covered = sum(k for _, _, k in tiles)
                if tiles and covered >= min_coverage * len(own):
                    out.append((doc_id, item_id, len(own), covered, len(tiles), max(k for _, _, k in tiles)))
    return sorted(out)


def corpus():
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(400)] + ["the", "of", "é", "日本"] * 20
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, prose(rng.choice([1, 3, 4, 5, 12, 20, 40]))) for i in range(25)]
    documents = []
    for i in range(120):
        words = prose(rng.randint(0, 60))
        for _ in range(rng.randint(0, 2)):
            passage = list(rng.choice(items)[1])
            cut = rng.randint(0, len(passage))
            kind = rng.randrange(4)
            if kind == 0:
                passage = passage[cut:] + prose(rng.randint(0, 2)) + passage[:cut]  # reordered
            elif kind == 1:
                passage = passage[:cut]
            elif kind == 2 and passage:
                passage[rng.randrange(len(passage))] = "other"
            at = rng.randint(0, len(words))
            words[at:at] = [w.upper() + rng.choice(["", ",", "."]) for w in passage]
        documents.append((i, " ".join(words)))
    texts = [(i, " ".join(w)) for i, w in items]
    return [*documents, (900, None), (901, ""), (902, "..."), documents[3]], [*texts, (90, None), (91, ""), (92, "!!"), texts[2]]


def test_matches_equal_brute_force(documents, spark, monkeypatch):
    docs, items = corpus()
    given = spark.createDataFrame(items, "item_id long, text string")
    expected = brute(docs, items, 5, 0.6)
    assert any(m[4] > 1 for m in expected) and len(expected) > 40
    for size in (1 << 20, 300):  # one block, several blocks
        monkeypatch.setattr(T, "BLOCK_BYTES", size)
        found = T.contaminated(documents(docs), given).drop("coverage").collect()
        assert sorted(map(tuple, found)) == expected


def test_nothing_extra_columns_and_long_text(documents, spark):
    items = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    empty = items.limit(0)
    docs = documents([(1, "x " * 200_000 + "one two three four five six" + " y" * 200_000)]).selectExpr("*", "1 as item", "2 as id")
    assert [r["doc_id"] for r in T.contaminated(docs, items).collect()] == [1]
    assert T.contaminated(docs, empty).count() == 0
    assert T.contaminated(documents([]), items).count() == 0
