import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from tidemark.llm import common, line_rules as L

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": dup,
        "n_repeat_words": len(covered),
    }


def normal(line):
    fold = lambda w: re.sub("[0-9]", "0", re.sub("[A-Z]", lambda m: m[0].lower(), w))
    return " ".join(fold(w) for w in WORD.findall(line))


def brute_judged(rows, max_documents, one_in=20):
    count, held = Counter(), Counter(host for _, _, host in rows)
    for _, text, host in rows:
        for line in {normal(x) for x in (text or "").split("\n")} - {""}:
            count[host, line] += 1
    out = []
    for doc_id, text, host in rows:
        base = brute(text)
        failed = base["n_words"] < 50 or 100 * base["n_repeat_words"] > 50 * base["n_words"]
        over = lambda x: count[host, normal(x)] > max_documents and one_in * count[host, normal(x)] > held[host]  # noqa: E731, B023
        lost = sum(len(WORD.findall(x)) for x in (text or "").split("\n") if over(x))
        out.append((doc_id, *base.values(), failed, lost, not failed and 5 * lost <= base["n_words"]))
    return sorted(out, key=str)


def rows():
    rng = random.Random(9)
    words = ["a", "B", "é", "日本", "x1", "x2", "#", "|", "\x1c", "foo", "Foo", "<b>"] + [f"w{i}" for i in range(60)]
    lines = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 25))) for _ in range(40)]
    out = [(None, None, None), (0, "", "h"), (0, "", "h"), (5, "\n \n\t\n", None)]
    for i in range(300):
        own = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(0, 4))]
        text = rng.choice(["\n", "\r\n", "\n\n "]).join(own + rng.choices(lines, k=rng.randint(0, 3)))
        out.append((i, text, rng.choice(["h", "h", "g", None])))
    return out


def test_counts_equal_brute_force(monkeypatch):
    monkeypatch.setattr(common, "SLICE", 50)
    texts = [r[1] for r in rows()]
    for low, high, data, offsets in common.text_blocks(pa.array(texts, pa.string()), 700):
        counts, _ = L.measure(data, offsets)
        for i in range(high - low):
            assert {c: int(counts[c][i]) for c in L.COUNTS} == brute(texts[low + i])


def test_verdicts_equal_brute_force(documents):
    given = rows()
    for limit in (3, 20):
        got = L.judged(documents(given), max_documents=limit).select(
            "doc_id", *L.COUNTS, "base_failed", "n_removed_words", "kept"
        )
        got = sorted((tuple(r) for r in got.collect()), key=str)
        assert got == brute_judged(given, limit)
    assert {r[-1] for r in got} == {True, False}


def test_limit_follows_the_size_of_a_host(documents):
    def host(name, size, shared, first):
        lines = lambda i: "word%d of a line\n" % i if i >= shared else "shared by some\n"
        return [(first + i, lines(i) + "".join(chr(97 + (i >> k) % 26) + " " for k in range(60)), name) for i in range(size)]

    # 8 of 20 documents, and of the NULL host; 8 of 400.
    given = [*host("small", 20, 8, 0), *host("large", 400, 8, 1000), *host(None, 20, 8, 2000)]
    # Digits are alike, so the other lines are shared by all but those; they are of four words.
    judged = lambda **limits: {
        r["doc_id"]: r["n_removed_words"] for r in L.judged(documents(given), **limits).collect()
    }
    fixed, share = judged(max_documents=5, max_host_share=None), judged(max_documents=5, max_host_share=0.1)
    assert [fixed[i] for i in (0, 1000, 2000)] == [3, 3, 3]
    assert [share[i] for i in (0, 1000, 2000)] == [3, 0, 3]
    assert set(judged(max_documents=8, max_host_share=0.1)[i] for i in (0, 1000, 2000)) == {0}


def test_texts_lose_the_lines_over_the_limit(documents):
    given = rows() + [(5, "Cookie 1\n\nown words\ncookie 2", "k"), (None, "cookie 3\nown", "k"), (9, "cookie 4", "k"), (9, None, "k")]
    count = Counter()
    for _, text, host in given:
        for line in {normal(x) for x in (text or "").split("\n")} - {""}:
            count[host, line] += 1
    expected = Counter()
    for doc_id, text, host in given:
        left = text and "\n".join(x for x in text.split("\n") if count[host, normal(x)] <= 2)
        expected[doc_id, left, len(WORD.findall(text or "")) - len(WORD.findall(left or ""))] += 1
    got = L.cleaned(documents(given), max_documents=2, max_host_share=None).select("doc_id", "text", "n_removed_words").collect()
    assert Counter(tuple(r) for r in got) == expected
    assert expected[5, "\nown words", 4] == expected[None, "own", 2] == expected[9, "", 2] == expected[9, None, 0] == 1


def test_the_rules_fire_on_the_example_tables(spark):
    """Lines go, and some documents that pass the base rules are depleted by that."""
    rows = L.judged(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    assert rows.where("n_removed_words > 0").count() > 50
    assert rows.where("NOT base_failed AND NOT kept").count() > 0
    assert rows.where("base_failed AND kept").count() == 0


def test_extra_columns_long_text_and_nothing(documents):
    df = documents([(1, "word " * 300_000)]).selectExpr("*", "1 as row", "2 as host", "3 as kept", "4 as id")
    row = L.judged(df).first()
    assert (row["n_words"], row["n_repeat_words"], row["kept"]) == (300_000, 300_000, False)
    assert L.judged(documents([])).count() == 0


def test_words_of_one_long_word():
    data = np.frombuffer(b"a" * 3_000_000, np.uint8)
    found = common.words(data, np.array([0, len(data)]))
    assert len(found) == 1 and found.end[0] == len(data)
