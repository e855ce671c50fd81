import random
import re
from collections import Counter, defaultdict

import numpy as np

from tidemark.llm import divergence as D

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
FIELDS = "lang string, source string, text string"


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in TERM.findall(text or "")]


def brute(rows, least, top, pseudo=5, scale=10**9):
    docs, by_lang, by_group, groups = Counter(), Counter(), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        found = terms(text)
        docs.update((lang, w) for w in set(found))
        by_lang.update((lang, w) for w in found)
        by_group[lang, source].update(found)
    out = []
    for lang, sources in groups.items():
        kept = [w for (x, w), n in docs.items() if x == lang and n >= least]
        share = lambda count, total: 1 + scale * (count + pseudo) // (total + pseudo * len(kept))  # noqa: E731, B023
        whole = sum(by_lang[lang, w] for w in kept)
        p = {}
        for s in sources:
            total = sum(by_group[lang, s][w] for w in kept)
            p[s] = {w: share(by_group[lang, s][w], total) for w in kept}
        for s in sources:
            pairs = [(sum(abs(p[s][w] - p[t][w]) for w in kept), t) for t in sources - {s}]
            above = [(p[s][w] - share(by_lang[lang, w], whole), w) for w in kept if by_group[lang, s][w]]
            above = [x for x in above if x[0] > 0]
            for part, found, limit in (("pair", pairs, len(pairs)), ("term", above, top)):
                found = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:limit]
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(found)]
    return sorted(out)


def some_rows():
    rng = random.Random(4)
    words = ["a", "Zebra", "zebra", "é", "ÉTÉ", "straße", "日本語", "x" * 8, "x" * 9, "y" * 16, "y" * 17, "q" * 70, "q" * 71]
    words += [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    rows = []
    for _ in range(240):
        text = rng.choice([" ", "\n", "-", "1"]).join(rng.choices(words, k=rng.randint(0, 40)))
        rows.append((rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", "Ä", None]), text))
    rows += rows[:20]
    rows += [("en", "empty", None), ("en", "marks", "1 2 3 [] {}"), ("fr", "s1", "une seule"), ("fr", "s2", None)]
    return rows + [("en", "s1", "zebra " * 30_000), ("it", "alone", "ciao")]


def collected(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def test_equals_brute_force(spark):
    rows = some_rows()
    df = spark.createDataFrame(rows, FIELDS).repartition(5)
    assert collected(D.audited(df, min_documents=5, top=7)) == brute(rows, 5, 7)


def test_many_slices_in_one_task(spark, monkeypatch):
    monkeypatch.setattr(D, "SLICE", 10)
    rows = some_rows()
    df = spark.createDataFrame(rows, FIELDS).coalesce(1)
    assert collected(D.audited(df, min_documents=3, top=50)) == brute(rows, 3, 50)


def test_no_rows_and_clashing_columns(spark):
    none = spark.createDataFrame([], FIELDS)
    assert collected(D.audited(none)) == []
    odd = spark.createDataFrame(
        [("x", "p", "a b", 1, 2, 3), ("x", "q", "a", 1, 2, 3)], "lang string, source string, text string, term int, rank int, slice int"
    )
    assert collected(D.audited(odd, min_documents=1)) == brute([("x", "p", "a b"), ("x", "q", "a")], 1, 50)


def test_radix_order_and_merged_runs():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 5, 1000).astype(np.uint64), rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
    b[::3] = b[0]
    assert (D.radix_order([a, b]) == np.lexsort((b, a))).all()
    counts = D.Counts()
    counts.groups[("en", "s")] = 0
    texts = [b"Ab ab", b"ab", b"long" * 9 + b" ab", "é".encode()]
    for half in (texts[:2], texts[2:]):
        offsets = np.cumsum([0, *map(len, half)])
        counts.add(np.frombuffer(b"".join(half), np.uint8), offsets, np.zeros(2, np.int64))
    found = [row for batch in counts.flush() for row in batch.to_pylist()]
    assert {(r["term"], r["n"], r["docs"]) for r in found} == {("ab", 4, 3), ("long" * 9, 1, 1), ("é", 1, 1)}
    assert not counts.held()
