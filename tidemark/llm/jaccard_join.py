"""Exact similarity join of texts on their sets of word shingles, as components.

Two texts link when the Jaccard similarity of their sets is at least 4/5. Links
are found by a search for shared tokens (T-occurrence):

1. A set's prefix are its first ``n // 5 + T`` shingles in one global order, with
   ``T = 1 + n // 40``. Two linked sets share at least the smaller ``T`` in their
   prefixes, and more the nearer their sizes are: all that they must share but what
   the longer of the rests can hold. The order puts shingles that are frequent in a sample last, the most
   frequent at the end, so that prefixes hold the rare ones; any order gives the same links. The sample is
   a share of the texts, so that lists of prefixes do not grow with the number of texts.
2. Equal sets are one class from here on, known by a 64-bit digest. Shingles of
   prefixes become inverted lists of classes; those of one class are dropped.
3. Near copies are joined to leaders first: each class is compared exactly with
   the leaders of many of its lists. Linked classes form components,
   and lists within one component need no further search. What is left is compared
   with the leaders of its lists again, others each round, while that joins components.
4. Every class then searches the lists that hold other components, by DivideSkip:
   its longest lists, fewer than the ``T`` that any partner must reach, are left
   out of the heap-merge; candidates from the merged short lists are looked up in
   the long ones by binary search, and given up when they can't reach what the
   pair must share. Of
   two components the smaller one searches. A long list is cut into parts by a
   hash of the class, so that no task holds a whole one.
5. Candidates are compared exactly, a class with those of another component until
   one of them links: one link joins two components. The links of all steps give
   the components.

Nothing is capped: leaders and sample only decide what is compared when.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import as_longs, in_arrow, mixed, row_key, sent_whole, shingles, text_blocks, without, words
from tidemark.llm.components import components
from tidemark.workspace import pin, tidy, unpin

WIDTH = 5
#: Texts that the order's frequent shingles are drawn from, and how many of those there may be.
SAMPLE_TEXTS, FREQUENT_IN, MOST_FREQUENT = 10_000, 5, 200_000
#: One in so many texts is drawn where that is more. A shingle in ``FREQUENT_IN`` times as many texts comes late.
SAMPLED_ONE_IN = 25
#: Classes whose digests may be broadcast; beyond it they are joined.
MOST_BROADCAST = 1_000_000
#: Leaders that a class is compared with in a round.
LEADERS = 2
#: In the first round, a leader is compared with where it leads one in so many of a class's shingles.
LEADS_ONE_IN = 12
#: Rounds go on while they merge more than one in so many of the components that are left.
MERGED_ONE_IN = 10
#: Entries of an inverted list, and classes to compare with, that a part should hold;
#: and searches that are compared with a part at a time.
PART, ASKING = 512, 256
#: Digests that a task remembers so as not to send a set twice.
REMEMBERED = 200_000


def set_of(hashes: np.ndarray) -> np.ndarray:
    return np.unique(hashes)


def digest(members: np.ndarray) -> int:
    """A 64-bit number of a set of shingles."""
    total = mixed(members).sum(dtype=np.uint64) + np.array([len(members)], np.uint64)
    return int(as_longs(mixed(total))[0])


def prefix_size(n: int) -> int:
    return min(n, n // 5 + 1 + n // 40)


def least_shared(n: Column) -> Column:
    """What the prefix of a set of ``n`` shares at least with that of any set linked to it."""
    return F.lit(1) + F.floor(F.floor((4 * n + 4) / 5) / 40).cast("int")


def must_share(n: int, m: int) -> int:
    """What the prefixes of two linked sets of these sizes share at least; more than they have if sizes forbid a link."""
    if 5 * min(n, m) < 4 * max(n, m):
        return n + m
    rest = max(n - prefix_size(n), m - prefix_size(m))
    return max(1, -(-4 * (n + m) // 9) - rest)


def _sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and set of each text with words."""
    for low, high, data, offsets in text_blocks(column):
        values, begins = shingles(words(data, offsets), WIDTH)
        for i in range(high - low):
            if begins[i + 1] > begins[i]:
                yield low + i, set_of(values[begins[i] : begins[i + 1]])


def frequent_shingles(texts: DataFrame) -> np.ndarray:
    """Hashes of the shingles that are frequent in a sample of texts, the most frequent first."""
    rows = texts.count()
    share = min(1.0, max(SAMPLE_TEXTS / max(1, rows), 1 / SAMPLED_ONE_IN))
    drawn = F.pmod(F.xxhash64("text", F.lit("sample")), F.lit(1 << 30)) < int((1 << 30) * share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [members for _, members in _sets(batch.column(0))]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(as_longs(np.concatenate(found)))], names=["token"])

    counts = in_arrow(texts.where(drawn), run, "token long").groupBy("token").count()
    common = counts.where(F.col("count") >= FREQUENT_IN).orderBy(F.desc("count"), "token").limit(MOST_FREQUENT)
    return np.array([r[0] for r in common.select("token").collect()], np.int64).view(np.uint64)


def prefixes(texts: DataFrame, frequent: np.ndarray) -> DataFrame:
    """Per row: ``id``, ``n`` (size of its set), ``key`` (its class), ``tokens`` (its prefix).

    A task sends the prefix of a class that it remembers once.
    """
    places = np.argsort(frequent)
    shared = texts.sparkSession.sparkContext.broadcast((frequent[places], places))
    kind = texts.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, places = shared.value
        sent: set[int] = set()
        for batch in batches:
            rows = batch.num_rows
            sizes, keys = np.zeros(rows, np.int32), np.zeros(rows, np.int64)
            parts: list[np.ndarray] = []
            ends = np.zeros(rows + 1, np.int32)
            for i, members in _sets(batch.column(1)):
                sizes[i], keys[i] = len(members), digest(members)
                if keys[i] in sent:
                    continue
                if len(sent) >= REMEMBERED:
                    sent.clear()
                sent.add(int(keys[i]))
                n = len(members)
                if len(common):
                    at = np.minimum(np.searchsorted(common, members), len(common) - 1)
                    late = common[at] == members
                    if late.any():
                        last = np.argsort(-places[at[late]])
                        members = np.concatenate([members[~late], members[late][last]])
                parts.append(members[: prefix_size(n)])
                ends[i + 1] = len(parts[-1])
            tokens = as_longs(np.concatenate(parts)) if parts else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum(ends, dtype=np.int32)), pa.array(tokens))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes), pa.array(keys), lists], names=["id", "n", "key", "tokens"]
            )

    return in_arrow(texts, run, f"id {kind}, n int, key long, tokens array<long>")


def sets_of(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """``key`` and ``members`` (sorted hashes, packed) of the classes in ``keys`` (stored), read from the texts."""
    few = keys.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST
    wanted = None
    if few:
        arrow = keys.select("key").toArrow()
        found = np.unique(arrow.column(0).to_numpy().astype(np.int64))
        wanted = texts.sparkSession.sparkContext.broadcast(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if wanted is None else wanted.value
        sent: set[int] = set()
        for batch in batches:
            out_keys, out = [], []
            for _, members in _sets(batch.column(0)):
                key = digest(members)
                if known is not None:
                    at = np.searchsorted(known, key)
                    if at == len(known) or known[at] != key:
                        continue
                if key in sent:
                    continue
                if len(sent) >= REMEMBERED:
                    sent.clear()
                sent.add(key)
                out_keys.append(key)
                out.append(members.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(out_keys, pa.int64()), pa.array(out, pa.binary())], names=["key", "members"]
            )

    found = in_arrow(texts, run, "key long, members binary")
    if not few:
        found = found.join(keys.select("key"), "key", "left_semi")
    return found.dropDuplicates(["key"])


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sets of sorted hashes are similar enough."""
    if len(x) > len(y):
        x, y = y, x
    if 5 * len(x) < 4 * len(y):
        return False
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    both = int((y[at] == x).sum())
    return 100 * both >= 80 * (len(x) + len(y) - both)


def linked(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of the distinct ``pairs`` (``a``, ``b``) of classes whose ``sets`` are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [
                similar(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64))
                for x, y in zip(batch.column(2), batch.column(3), strict=True)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    one = sets.select(F.col("key").alias("a"), F.col("members").alias("x"))
    other = sets.select(F.col("key").alias("b"), F.col("members").alias("y"))
    whole = other.join(pairs.select("a", "b"), "b").join(one, "a").select("a", "b", "x", "y")
    return in_arrow(whole, run, "a long, b long")


def linked_to_components(sets: DataFrame, asked: DataFrame, named: DataFrame) -> DataFrame:
    """Links (``a``, ``b``) of classes ``x`` to those among ``found``, which are of one component.

    Components that ask each other, over any number of steps, are compared in one
    place, cut by a hash of the class into parts. A set is sent once to every part
    where it is needed, not once for each pair. Of each row of ``asked`` and part
    the first link found is given. ``named`` has the component of every class.
    """
    pieces = components(asked.select(F.col("x_component").alias("a"), F.col("component").alias("b")), "pieces")
    pieces = sent_whole(pieces.select(F.col("node").alias("component"), F.col("component").alias("piece")))
    placed = named.join(pieces, "component").select("piece", "key")
    sizes = placed.groupBy("piece").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    pieces = sent_whole(pin(pieces.join(sizes, "piece"), "pieces"))
    part = lambda key, parts: F.pmod(F.xxhash64(key), parts).cast("int")
    asking = (
        asked.join(pieces, "component")
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("found", F.filter("found", lambda z: part(z, F.col("parts")) == F.col("part")))
        .where(F.size("found") > 0)
        .select("piece", "part", "x", "found")
    )
    asking = pin(asking, "asking")
    turns = asking.groupBy("piece", "part").agg(F.ceil(F.count("*") / ASKING).cast("int").alias("turns"))
    turns = sent_whole(pin(turns, "turns"))
    turn = F.pmod(F.xxhash64("x", F.lit("turn")), F.col("turns")).cast("int").alias("turn")
    asking = asking.join(turns, ["piece", "part"]).select("piece", "part", turn, "x", "found")
    given = (
        named.join(pieces, "component")
        .select("piece", part("key", F.col("parts")).alias("part"), "key")
        .join(turns, ["piece", "part"])
        .select("piece", "part", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("turn"), "key")
        .union(asking.select("piece", "part", "turn", "x"))
        .distinct()
    )
    rows = (
        given.join(sets, "key")
        .select("piece", "part", "turn", F.lit(0).alias("asks"), "key", "members", F.lit(None).cast("array<long>").alias("found"))
        .union(asking.select("piece", "part", "turn", F.lit(1), "x", F.lit(None).cast("binary"), "found"))
    )
    block = ["piece", "part", "turn"]
    rows = rows.repartition(*block).sortWithinPartitions(*block, "asks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, {}
        for batch in batches:
            out = []
            blocks = zip(*[batch.column(k).to_pylist() for k in range(3)], strict=True)
            members, found = batch.column(5), batch.column(6)
            for i, (where, asks, key) in enumerate(
                zip(blocks, batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)
            ):
                if where != at:
                    at, held = where, {}
                if not asks:
                    held[key] = np.frombuffer(members[i].as_py(), np.uint64)
                    continue
                link = next((z for z in found[i].as_py() if similar(held[key], held[z])), None)
                if link is not None:
                    out.append((min(key, link), max(key, link)))
            a, b = ([pair[k] for pair in out] for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return in_arrow(rows, run, "a long, b long")


def with_component(entries: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Entries of inverted lists with the component of their class, and its number of classes."""
    if labels is None:
        return entries.withColumns({"component": F.col("key"), "size": F.lit(1).cast("long")})
    sizes = labels.groupBy("component").agg(F.count("*").alias("size"))
    named = labels.join(sizes, "component").select(F.col("node").alias("key"), "component", "size")
    named = sent_whole(named, labels)
    return entries.join(named, "key", "left").withColumns(
        {"component": F.coalesce("component", "key"), "size": F.coalesce("size", F.lit(1).cast("long"))}
    )


def mixed_lists(entries: DataFrame) -> DataFrame:
    """Entries of the lists that hold more than one component, with the list's size ``df`` and leader, of size ``leader_n``.

    ``last`` is the component that comes last in the list, by its size.
    """
    lead = F.min(F.struct(F.xxhash64("key", "round").alias("order"), F.col("key"), F.col("component"), F.col("n")))
    last = F.max(F.struct("size", "component"))
    ends = [F.min("component").alias("low"), F.max("component").alias("high")]
    lists = (
        entries.groupBy("token")
        .agg(F.count("*").alias("df"), *ends, lead.alias("leader"), last.alias("last"))
        .where("low != high")
        .select(
            "token",
            "df",
            F.col("leader.key").alias("leader"),
            F.col("leader.component").alias("leads"),
            F.col("leader.n").alias("leader_n"),
            F.col("last.component").alias("last"),
        )
    )
    return entries.join(lists, "token")


def divide_skip(short: list[np.ndarray], long: list[np.ndarray], needed: Callable[[int], int]) -> list[int]:
    """Members that are in as many of the sorted lists as ``needed`` says; it is more than there are long lists."""
    out = []
    for member, times in groupby(heapq.merge(*[a.tolist() for a in short])):
        count, left, least = sum(1 for _ in times), len(long), needed(member)
        for a in long:
            if count >= least or count + left < least:
                break
            at = np.searchsorted(a, member)
            count += int(at < len(a) and a[at] == member)
            left -= 1
        if count >= least:
            out.append(member)
    return out


def parts_for(entries: DataFrame) -> int:
    """Parts, a power of two, by which the longest list is cut into short enough ones."""
    largest, parts = entries.agg(F.max("df")).first()[0] or 0, 1
    while parts * PART < largest:
        parts *= 2
    return parts


def near_in_size(n: Column, m: Column) -> Column:
    """Whether sets of these sizes can be linked."""
    return 5 * F.least(n, m) >= 4 * F.greatest(n, m)


def part_of(key: str, parts: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def searched(entries: DataFrame, parts: int) -> DataFrame:
    """Per class ``x`` and other component: ``found``, its classes that share enough tokens with
    ``x``, from mixed lists' entries; a row for each part of the lists.

    Of a list a class is sent only the members that it may link to, and that it has to search for.
    """
    sized = entries.withColumn("part", part_of("key", parts))
    # A class's long lists are chosen among all its mixed lists, asking there or not.
    ranked = Window.partitionBy("key").orderBy(F.desc("df"), "token")
    placed = entries.withColumn("place", F.row_number().over(ranked))
    # The searching side: all but those of the component that comes last in their list.
    asking = placed.where(F.col("component") != F.col("last")).select(
        "token",
        F.col("key").alias("x"),
        F.col("size").alias("x_size"),
        F.col("component").alias("x_component"),
        F.col("n").alias("x_n"),
        (F.col("place") < least_shared(F.col("n"))).alias("long"),
    )
    member = F.struct("key", "size", "component", "n")
    lists = sized.groupBy("token", "part").agg(F.sort_array(F.collect_list(member)).alias("members"))
    later = lambda z: (z["size"] > F.col("x_size")) | (
        (z["size"] == F.col("x_size")) & (z["component"] > F.col("x_component"))
    )
    wanted = F.filter("members", lambda z: near_in_size(z["n"], F.col("x_n")) & later(z)).alias("members")
    rows = asking.join(lists, "token").select("x", "part", "x_component", "x_n", "long", wanted).where(F.size("members") > 0)
    apart = [F.col(f"members.{c}").alias(c) for c in ("key", "component", "n")]
    rows = rows.select("x", "part", "x_component", "x_n", "long", *apart)
    rows = rows.repartition("x", "part").sortWithinPartitions("x", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def entries_() -> Iterator[tuple]:
            for batch in batches:
                keys, comps, ns = (np.asarray(batch.column(k).flatten()) for k in range(5, 8))
                bounds = np.concatenate([[0], np.cumsum(batch.column(5).value_lengths().to_numpy())])
                head = list(zip(*[batch.column(i).to_pylist() for i in range(5)], strict=True))
                for i, (x, part, component, n, is_long) in enumerate(head):
                    cut = slice(bounds[i], bounds[i + 1])
                    yield (x, part, component), n, is_long, keys[cut], ns[cut], comps[cut]

        for (x, _, own), group in groupby(entries_(), key=lambda e: e[0]):
            short, long, known, n = [], [], {}, 0
            for _, n, is_long, members, ns, comps in group:  # noqa: B007
                if is_long:
                    long.append(members)
                else:
                    short.append(members)
                    known.update(zip(members.tolist(), zip(ns.tolist(), comps.tolist(), strict=True), strict=True))
            needed = lambda z, n=n, known=known: must_share(n, known[z][0])
            by_component = defaultdict(list)
            for z in divide_skip(short, long, needed):
                by_component[known[z][1]].append(z)
            if by_component:
                k = len(by_component)
                columns = [[x] * k, [own] * k, list(by_component), list(by_component.values())]
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
                    names=["x", "x_component", "component", "found"],
                )

    return in_arrow(rows, run, "x long, x_component long, component long, found array<long>")


def leader_pairs(lists: DataFrame, one_in: int | None) -> DataFrame:
    """Distinct pairs (``a``, ``b``) of classes of ``mixed_lists`` and the leaders of many of their lists.

    A leader comes before a class in one order of all, so no two classes lead each other.
    """
    led = lists.where("component != leads").where(near_in_size(F.col("n"), F.col("leader_n")))
    to = led.repartition("key").groupBy("key", "leader").agg(F.count("*").alias("times"), F.first("n").alias("n"))
    best = Window.partitionBy("key").orderBy(F.desc("times"), "leader")
    often = F.lit(True) if one_in is None else one_in * F.col("times") >= F.col("n")
    near = to.where(often).withColumn("place", F.row_number().over(best)).where(F.col("place") <= LEADERS)
    return near.select(F.least("key", "leader").alias("a"), F.greatest("key", "leader").alias("b"))


def searching(lists: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries of ``mixed_lists`` without the classes that are in fewer of them than any partner must share.

    With them ``key``, ``component`` and ``size`` of the classes that stay, stored.
    """
    firsts = [F.first(c).alias(c) for c in ("n", "component", "size")]
    enough = lists.groupBy("key").agg(F.count("*").alias("lists"), *firsts)
    enough = enough.where(F.col("lists") >= least_shared(F.col("n"))).select("key", "component", "size")
    enough = pin(enough, "enough")
    entries = lists.join(sent_whole(enough.select("key")), "key")
    return entries.select("token", "key", "n", "component", "size"), enough


def merged(entries: DataFrame, classes: DataFrame, links: DataFrame) -> tuple[DataFrame, int]:
    """Entries of ``classes`` with the components that ``links`` join as one, and how many are joined to another."""
    of = sent_whole(classes.select("key", "component"))
    one = of.select(F.col("key").alias("a"), F.col("component").alias("x"))
    other = of.select(F.col("key").alias("b"), F.col("component").alias("y"))
    between = links.join(one, "a").join(other, "b").where("x != y").select(F.col("x").alias("a"), F.col("y").alias("b"))
    to = components(between, "merged")
    into = sent_whole(to.withColumnRenamed("component", "into"))
    sizes = classes.join(into, F.col("component") == F.col("node")).select("node", "into", "size").distinct()
    total = sizes.groupBy("into").agg(F.sum("size").alias("in_all"))
    to = pin(sizes.select("node", "into").join(total, "into"), "merged")
    renamed = entries.join(sent_whole(to), F.col("component") == F.col("node"), "left").select(
        "token",
        "key",
        "n",
        F.coalesce("into", "component").alias("component"),
        F.coalesce("in_all", "size").alias("size"),
    )
    return renamed, to.where("node != into").count()


def shared_tokens(sets: DataFrame) -> DataFrame:
    """Entries (``token``, ``key``, ``n``) of the inverted lists of the prefixes in ``sets``, but of lists of one row."""
    postings = sets.select(F.explode("tokens").alias("token"), "key", "n")
    shared = postings.groupBy("token").agg(F.count("*").alias("times")).where("times > 1").select("token")
    return postings.join(shared, "token").groupBy("token", "key").agg(F.first("n").alias("n"))


def classes_with_links(texts: DataFrame, entries: DataFrame) -> DataFrame:
    """Links (``a``, ``b``) between classes, enough to connect all that are connected.

    ``entries`` is a pinned table, which goes: what no step reads again is deleted at
    once, so that disks hold the tables of one step.
    """
    at = lambda turn: F.lit(turn).alias("round")
    lists = mixed_lists(with_component(entries, None).select("*", at(0)))
    pairs = pin(leader_pairs(lists, LEADS_ONE_IN), "pairs")
    keys = pairs.select(F.col("a").alias("key")).union(pairs.select("b"))
    members = pin(sets_of(texts, keys), "sets")
    found = pin(linked(members, sent_whole(pairs)), "links")
    unpin(members)
    labels = components(found)
    lists = mixed_lists(with_component(entries, labels).select("*", at(0)))
    lists = pin(lists.drop("round", "leader", "leads", "leader_n", "last"), "mixed")
    unpin(entries)
    rest, classes = searching(lists)
    rest = pin(rest, "rest")
    unpin(lists)
    members = pin(sets_of(texts, classes), "sets")
    turn = 0
    while True:
        # Near copies that the first leaders left apart: many small components would ask each other.
        turn += 1
        lists = pin(mixed_lists(rest.select("*", at(turn))).drop("last"), "lists")
        unpin(rest)
        pairs = pin(leader_pairs(lists, None), "pairs")
        links = pin(linked(members, sent_whole(pairs)), "links")
        left = lists.select("component").distinct().count()
        rest, joined = merged(*searching(lists), links)
        rest = pin(rest, "rest")
        unpin(lists)
        found = found.union(links)
        if joined * MERGED_ONE_IN <= left:
            break
    lists = pin(mixed_lists(rest.select("*", at(0))).drop("round", "leader", "leads", "leader_n"), "lists")
    unpin(rest)
    named = lists.select("key", "component").distinct()
    asked = pin(searched(lists, parts_for(lists)), "asked")
    tidy(texts.sparkSession)
    return found.union(pin(linked_to_components(members, asked, named), "links"))


def clustered(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_shingles``, ``component_id`` (the smallest id reachable by links, its own included).

    NULL texts and texts without words have no shingle and no links; their component
    is their own id. Repeated rows are equal sets and share a component.
    """
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    texts = rows.select("text").where(F.col("text").isNotNull())
    whole = pin(prefixes(rows, frequent_shingles(texts)), "prefixes")
    entries = pin(shared_tokens(whole.where("n > 0")), "entries")
    sets = pin(whole.select("id", "n", "key"), "classes")
    unpin(whole)
    full = sets.where("n > 0")
    labels = components(classes_with_links(texts, entries)).withColumnRenamed("node", "key")
    labels = sent_whole(labels)
    # A component without links is a class, whose smallest id is found for all classes.
    first = full.groupBy("key").agg(F.min("id").alias("first"))
    smallest = full.join(labels, "key").groupBy("component").agg(F.min("id").alias("least"))
    smallest = sent_whole(pin(smallest, "smallest"))
    joined = first.join(labels, "key", "left").join(smallest, "component", "left")
    named = joined.select(F.col("key").alias("class"), F.coalesce("least", "first").alias("component_id"))
    named = pin(named, "named")
    out = sets.select("id", "n", "key").join(named, (F.col("key") == F.col("class")) & (F.col("n") > 0), "left")
    return out.select(
        F.col("id").alias(id_col),
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
    )


def representatives(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``documents`` with one of each component: that with the smallest id.

    Texts without words, and rows without an id, stay. Of rows that repeat id and
    text one stays if they have words; rows that share an id alone are rows of their own.
    """
    rows = documents.select(row_key(id_col, text_col).alias("row"), F.col(text_col).alias("text"))
    found = pin(clustered(rows, "row", "text"), "components")
    some = found.where((F.col("n_shingles") > 0) & ~F.col("row.none"))
    first = F.col("component_id") == F.col("row")
    out = without(documents, pin(some.where(~first).select("row"), "copies"), id_col, text_col)
    repeated = some.where(first).groupBy("row").count().where("count > 1").select("row")
    repeated = pin(repeated, "repeated")
    if repeated.isEmpty():
        return out
    one = without(documents, repeated, id_col, text_col, "left_semi").dropDuplicates([id_col, text_col])
    return without(out, repeated, id_col, text_col).unionByName(one)
