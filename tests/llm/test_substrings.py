import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import substrings as S

FIELDS = "doc_id long, text string"
SPACES = " \t\n\x0b\x0c\r"


def split(text):
    out, word = [], ""
    for c in text or "":
        if c in SPACES:
            out += [word] if word else []
            word = ""
        else:
            word += c
    return out + ([word] if word else [])


def brute(rows, window):
    """Per row of (id, text): n_words, n_removed, digest; rows in the order of their ids."""
    first, texts = {}, [(doc_id, split(text)) for doc_id, text in rows]
    for doc_id, words in sorted(texts, key=lambda r: (r[0] is None, r[0] or 0)):
        for i in range(len(words) - window + 1):
            first.setdefault(tuple(words[i : i + window]), (doc_id, i))
    out = []
    for doc_id, words in texts:
        gone = set()
        for i in range(len(words) - window + 1):
            if first[tuple(words[i : i + window])] != (doc_id, i):
                gone |= set(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc_id, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str)


def some_rows(window):
    rng = random.Random(window)
    vocabulary = [f"w{i}" for i in range(400)] + ["é", "日本", "\x1c", "#"]
    fresh = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    shared = [fresh(rng.randint(window - 1, 4 * window)) for _ in range(12)]
    rows = [(0, None), (1, ""), (2, " \n\t "), (3, "ein wort"), (None, " ".join(shared[0] + fresh(5)))]
    for i in range(4, 160):
        parts = []
        for _ in range(rng.randint(1, 5)):
            parts += rng.choice(shared) if rng.random() < 0.5 else fresh(rng.randint(0, 2 * window))
        if rng.random() < 0.1:
            parts += parts
        if rng.random() < 0.1:
            parts = ["a"] * rng.randint(1, 4 * window)
        rows.append((i, rng.choice([" ", "\n", "  ", "\t"]).join(parts)))
    # One passage in a third of all documents, each time with words of its own around it.
    for i in range(200, 280):
        rows.append((i, " ".join([f"x{i}", *shared[1][: window + 2], f"y{i}", *fresh(2 * window)])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("window", "group"), [(20, 6), (5, 2), (3, 3)])
def test_equals_brute_force(spark, window, group):
    rows = some_rows(window)
    df = spark.createDataFrame(rows, FIELDS).repartition(6)
    assert found(S.deduplicated(df, window=window, group=group)) == brute(rows, window)


def test_shards_parts_and_slices(spark, monkeypatch):
    monkeypatch.setattr(S, "SHARD", 3)
    monkeypatch.setattr(S, "SLICE", 4)
    rows = some_rows(8)
    df = spark.createDataFrame(rows, FIELDS).repartition(3)
    assert found(S.deduplicated(df, window=8, group=3)) == brute(rows, 8)


def test_repeated_rows_shared_ids_and_no_rows(spark):
    text = " ".join(f"t{i}" for i in range(30))
    rows = [(5, text), (5, text), (7, text + " end"), (8, "other " + text), (8, "other words")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], FIELDS + ", sha int, spans string")
    by_id = {}
    for r in S.deduplicated(df).collect():
        by_id.setdefault(r["doc_id"], []).append((r["n_removed"], r["text"]))
    assert by_id[5] == [(0, text), (0, text)]
    assert by_id[7] == [(30, "end")]
    assert sorted(by_id[8]) == [(0, "other words"), (30, "other")]
    assert found(S.deduplicated(df.limit(0))) == []
    with pytest.raises(ValueError):
        S.deduplicated(df, window=40, group=5)


def test_long_text(spark):
    base = [f"v{i % 977}-{i // 977}" for i in range(60_000)]
    rows = [(1, " ".join(base)), (2, " ".join(["new"] + base[20_000:20_050] + ["more"] + base[50_000:]))]
    assert found(S.deduplicated(spark.createDataFrame(rows, FIELDS))) == brute(rows, 20)


def test_automaton_statistics():
    rng = random.Random(2)
    letters = [b"a", b"b", b"c"]
    for _ in range(200):
        texts = [[rng.choice(letters) for _ in range(rng.randint(1, 12))] for _ in range(3)]
        automaton = S.Automaton()
        for k, text in enumerate(texts):
            automaton.add(text, [(k, i) for i in range(len(text))])
        query = [rng.choice(letters) for _ in range(15)]
        for i, (length, place) in enumerate(automaton.statistics(query, 2)):
            known = {tuple(t[j : j + n]) for t in texts for n in range(1, 13) for j in range(len(t) - n + 1)}
            assert length == max((n for n in range(1, i + 2) if tuple(query[i + 1 - n : i + 1]) in known), default=0)
            if length >= 2:
                pair = query[i - 1 : i + 1]
                ends = [(k, j + 1) for k, t in enumerate(texts) for j in range(len(t) - 1) if t[j : j + 2] == pair]
                assert place == min(ends)
            else:
                assert place is None


def test_units_follow_content():
    rng = random.Random(8)
    passage = [f"p{rng.randint(0, 50)}" for _ in range(60)]
    texts = [" ".join(["x"] * a + passage + ["y"] * b).encode() for a, b in ((0, 0), (7, 3), (25, 40))]
    offsets = np.cumsum([0, *map(len, texts)])
    text, start, size, seed, digest = S.units(np.frombuffer(b"".join(texts), np.uint8), offsets, 20, 6)
    assert size.max() <= 15
    for shift, k in ((7, 1), (25, 2)):
        own = {(s, d): p for t, p, s, d in zip(text, start, seed, digest, strict=True) if t == k}
        inner = [(s, d, p) for t, p, n, s, d in zip(text, start, size, seed, digest, strict=True) if t == 0 and 0 < p and p + n < 41]
        assert inner and all(own[s, d] == p + shift for s, d, p in inner)
    assert (S.least(np.array([3, 1, 1, 2, 0], np.uint64), 3) == [1, 1, 4]).all()
