import os
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import common, components as G, jaccard_join as J

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    sets = [shingle_set(text) for _, text in rows]
    head = list(range(len(rows)))

    def find(i):
        while head[i] != i:
            head[i] = head[head[i]]
            i = head[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * len(sets[i] | sets[j]):
                head[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted((doc_id, len(sets[i]), least[find(i)]) for i, (doc_id, _) in enumerate(rows))


def corpus(seed, n=260):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)] + ["Ünï", "日本", "\x1c"]
    prose = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    passage = prose(40)
    bases = [prose(rng.choice([1, 2, 4, 5, 6, 9, 30, 60, 200])) for _ in range(25)]
    hot = prose(90)
    rows = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.3:
            words = list(hot)
            for _ in range(rng.randint(0, 5)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        elif kind < 0.65:
            words = list(rng.choice(bases))
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                at = rng.randrange(len(words) + 1)
                words[at : at + rng.randint(0, 1)] = prose(rng.randint(0, 2))
        else:
            words = prose(rng.randint(0, 80))
            words[rng.randint(0, len(words)) :] += passage
        rows.append((i, rng.choice([" ", "\n", "  "]).join(words).upper() if rng.random() < 0.1 else " ".join(words)))
    return [*rows, (900, None), (901, ""), (902, " \n"), (5, rows[5][1]), (903, rows[5][1])]


@pytest.mark.parametrize("seed,few", [(1, True), (2, False)])
def test_components_equal_brute_force(documents, monkeypatch, seed, few):
    if not few:  # the ways beyond the bounds
        monkeypatch.setattr(J, "MOST_BROADCAST", 3)
        monkeypatch.setattr(J, "SAMPLE_TEXTS", 20)
        monkeypatch.setattr(J, "PART", 4)
        monkeypatch.setattr(J, "ASKING", 2)
        monkeypatch.setattr(J, "MERGED_ONE_IN", 1)
        monkeypatch.setattr(J, "LEADERS", 1)
    rows = corpus(seed)
    got = sorted(tuple(r) for r in J.clustered(documents(rows)).collect())
    expected = brute(rows)
    assert got == expected
    assert len({r[2] for r in expected}) < len(expected) - 60


def near_copies(n, seed=3):
    """Copies of one text with eight of its two hundred words changed: some pairs link, some don't."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(n):
        words = list(base)
        for at in rng.sample(range(200), 8):
            words[at] = f"x{i}-{at}"
        rows.append((i, " ".join(words)))
    return rows


def test_near_copies_ask_about_few_components(documents, monkeypatch):
    """Rows to compare stay below the group's size, however large it is."""
    asked = []
    searched = J.searched
    monkeypatch.setattr(J, "searched", lambda *args: asked.append(searched(*args)) or asked[-1])
    for n in (100, 300):
        rows = near_copies(n)
        got = sorted(tuple(r) for r in J.clustered(documents(rows)).collect())
        if n == 300:
            assert got == brute(rows)
        assert asked[-1].count() < n


def test_divide_skip_counts_members():
    rng = random.Random(4)
    for _ in range(200):
        lists = [np.array(sorted(rng.sample(range(40), rng.randint(0, 30)))) for _ in range(rng.randint(1, 9))]
        lists.sort(key=len)
        skipped = rng.randint(0, len(lists) - 1)
        least = skipped + rng.randint(1, 3)
        short, long = lists[: len(lists) - skipped], lists[len(lists) - skipped :]
        expected = [m for m in range(40) if sum(m in set(a.tolist()) for a in lists) >= least]
        assert J.divide_skip(short, long, lambda _: least) == expected


def test_prefixes_share_what_they_must():
    rng = random.Random(6)
    for _ in range(3000):
        n = rng.choice([1, 2, 4, 5, 9, 40, 100, 300])
        both = rng.sample(range(5000), n)
        other = both[rng.randint(0, n // 4) :] + rng.sample(range(5000, 9000), rng.randint(0, n // 4))
        x, y = sorted(both), sorted(other)
        shared = len(set(x) & set(y))
        if not y or 100 * shared < 80 * (len(x) + len(y) - shared):
            continue
        seen = len(set(x[: J.prefix_size(len(x))]) & set(y[: J.prefix_size(len(y))]))
        assert seen >= J.must_share(len(x), len(y)) >= 1 + (-(-4 * len(x) // 5)) // 40


def test_long_chains_are_one_component(spark):
    links = spark.range(300).selectExpr("(id * 37) % 301 as a", "((id + 1) * 37) % 301 as b")
    assert {tuple(r) for r in G.components(links).collect()} == {(i, 0) for i in range(301)}


def test_nothing_extra_columns_and_long_text(documents):
    assert J.clustered(documents([])).count() == 0
    long = " ".join(f"x{i}" for i in range(60_000))
    df = documents([(3, long), (7, long + " end"), (9, None)]).selectExpr("*", "1 as key", "2 as n", "3 as tokens")
    assert sorted(map(tuple, J.clustered(df).collect())) == [(3, 59996, 3), (7, 59997, 3), (9, 0, 9)]


def trees(seed, groups=60, size=12):
    """Links that make a tree of each group of numbers, some twice, and the number that each belongs to."""
    rng = random.Random(seed)
    links, least = [], {}
    for _ in range(groups):
        nodes = rng.sample(range(-(1 << 61), 1 << 61), size)
        links += [(nodes[i], nodes[rng.randrange(i)]) for i in range(1, size)]
        least |= dict.fromkeys(nodes, min(nodes))
    return links + links[:9], least


@pytest.mark.parametrize("few", [True, False])
def test_components_write_few_tables(spark, monkeypatch, few):
    """Each table that is written is a round of tasks, however little there is in it."""
    if not few:  # the ways beyond the bounds
        monkeypatch.setattr(G, "HELD", 5)
        monkeypatch.setattr(common, "MOST_IDS", 2)
    written, pin = [], G.pin
    monkeypatch.setattr(G, "pin", lambda df, label: written.append(label) or pin(df, label))
    links, least = trees(5)
    got = G.components(spark.createDataFrame([*links, (7, 7)], "a long, b long").repartition(6)).collect()
    assert sorted(map(tuple, got)) == sorted((least | {7: 7}).items())
    assert not few or len(written) <= 10


def test_nothing_is_linked(spark):
    assert G.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_beyond_what_may_be_broadcast(documents, monkeypatch):
    monkeypatch.setattr(common, "MOST_IDS", 2)
    rows = corpus(7, 120)
    assert sorted(tuple(r) for r in J.clustered(documents(rows)).collect()) == brute(rows)


def test_lists_are_sent_only_where_a_link_can_be(spark, monkeypatch):
    """Of a list that texts of all sizes share, a class is sent the members near to it in size, each pair once."""
    sent, in_arrow = [], J.in_arrow
    monkeypatch.setattr(J, "in_arrow", lambda df, *args: sent.append(df) or in_arrow(df, *args))
    sizes = [4, 6, 8, 11, 14, 18, 24, 32, 42, 54]
    rows = [(token, 100 * i + k, n, 100 * i + k, 1) for token in (7, 8) for i, n in enumerate(sizes) for k in range(3)]
    entries = spark.createDataFrame(rows, "token long, key long, n int, component long, size long")
    lists = J.mixed_lists(entries.selectExpr("*", "0 as round"))
    found = J.searched(lists, 1).collect()
    pairs = {(r["x"], z) for r in found for z in r["found"]}
    assert pairs == {(100 * i + j, 100 * i + k) for i, n in enumerate(sizes) for j in range(3) for k in range(j + 1, 3) if J.must_share(n, n) <= 2}
    assert sent[-1].selectExpr("sum(size(key))").first()[0] == 2 * len(sizes) * 3


def test_tables_go_when_no_step_reads_them_again(documents, monkeypatch):
    """What is stored does not add up over the steps."""
    stored, pin = defaultdict(list), J.pin
    monkeypatch.setattr(J, "pin", lambda df, label: stored[label].append(pin(df, label)) or stored[label][-1])
    rows = corpus(11, 120)
    assert sorted(map(tuple, J.clustered(documents(rows)).collect())) == brute(rows)
    left = {k for k, frames in stored.items() for x in frames[: 1 if k == "sets" else None] if os.path.exists(x._pinned_at.removeprefix("file:"))}
    assert not left & {"prefixes", "entries", "mixed", "rest", "sets"}


def test_sample_grows_with_the_texts(documents, monkeypatch):
    """Lists of prefixes don't grow with the texts: a shingle in so many of them comes late, the most frequent last."""
    monkeypatch.setattr(J, "SAMPLE_TEXTS", 1)
    monkeypatch.setattr(J, "SAMPLED_ONE_IN", 1)
    often, most = "a b c d e", "v w x y z"
    texts = documents([(i, f"{often if i < 6 else ''} {most} " + " ".join(f"u{i}-{k}" for k in range(30))) for i in range(20)])
    frequent = J.frequent_shingles(texts.select("text"))
    last, late = (next(m for _, m in J._sets(pa.array([t])))[0] for t in (most, often))
    assert frequent[0] == last and late in frequent
    by_place = {r["id"]: list(np.array(r["tokens"]).view(np.uint64)) for r in J.prefixes(texts.selectExpr("doc_id as id", "text"), frequent).collect()}
    assert not any({last, late} & set(tokens) for tokens in by_place.values())
