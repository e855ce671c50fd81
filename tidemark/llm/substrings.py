"""Substring dedup: passages of texts that start earlier elsewhere, by suffix automata of reference shards.

A window is ``window`` consecutive words. It is removed where its words also start
earlier: in a document with a smaller id, or before in the same one. Windows are judged
on the texts as given; removed are all words that such a window covers.

1. Of the word groups in a window (``group`` words) the one with the least hash is its
   seed, the first of equals. Equal windows have equal seeds. Neighbouring windows with
   one seed form a unit, at most ``window - group + 1`` windows.
2. Seeds that occur once are dropped, units of equal words become one content, numbered in
   the order of first places. Only their words are read again.
3. Windows of contents are counted by hash. Each that occurs twice or more goes into
   the reference at its first place, and only there.
4. The reference is cut into shards by seed, and a shard that is too large into parts. A
   task builds the suffix automaton of a part from its words and streams contents of
   the same seeds through it: matching statistics, the length of the longest match that
   ends at each word. Where it reaches the window, the automaton gives the place, and the
   window is removed where that is before its own. Contents are dealt to slices of
   their shard, each of which is sent the shard's automaton: a hot seed is many tasks.
   A broadcast to all tasks would grow with the corpus, this does not.
5. Verdicts go back to all units of a content, and united they give the maximal spans
   of a document.

Hashes of windows only choose what is compared: the automata compare words.

A document is a row's id and text; NULL ids come last, and rows of one id by a
digest of the text. Equal rows are one document, with one result each. NULL is an
empty text without words; texts with fewer words than a window lose nothing; a text
is worked on whole (up to 2**31 bytes, as Spark hands it over). Other columns are
ignored; no rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import as_longs, in_arrow, mixed, powers, shingles, text_blocks, words
from tidemark.workspace import pin, tidy, unpin

#: Windows that make a shard of the reference, and contents that make a slice.
SHARD, SLICE = 50_000, 50_000


def window_hashes(hashes: np.ndarray, window: int) -> np.ndarray:
    """Hash of each run of ``window`` words, runs over the end of a text among them."""
    n = len(hashes)
    up, down = powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * up[:n], out=sums[1:])
    made = max(0, n - window + 1)
    return mixed((sums[window:] - sums[:made]) * down[:made])


def least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the least of each run of ``width`` values, the first of equals."""
    best = np.arange(len(values))
    done = 1
    while done < width and len(best):
        step = min(done, width - done)
        other = best[step:]
        best = best[: len(other)]
        best = np.where(values[other] < values[best], other, best)
        done += step
    return best


def units(data: np.ndarray, offsets: np.ndarray, window: int, group: int) -> tuple[np.ndarray, ...]:
    """Units of the texts between ``offsets``: text, first window, number of windows, seed, hash of their words."""
    found = words(data, offsets, fold=None)
    counts = np.diff(found.first)
    groups, begins = shingles(found, group, whole_if_short=False)
    made = np.maximum(counts - window + 1, 0)
    text = np.repeat(np.arange(len(made)), made)
    place = np.arange(len(text)) - np.repeat(np.cumsum(made) - made, made)
    seed_at = least(groups, window - group + 1)[begins[:-1][text] + place] if len(text) else text
    new = np.ones(len(text), bool)
    new[1:] = (seed_at[1:] != seed_at[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, len(text)))
    hashes = window_hashes(found.hashes, window)
    first = found.first[:-1][text[at]] + place[at]
    # The first and the last window hold all words of a unit.
    digest = mixed(hashes[first] + mixed(hashes[first + size - 1] ^ size.astype(np.uint64)))
    return text[at], place[at], size, groups[seed_at[at]], digest


def _unit_arrays(documents: DataFrame, window: int, group: int) -> DataFrame:
    """``id``, ``digest`` and arrays ``seeds``, ``shas``, ``starts``, ``sizes`` of documents that have a window."""
    kind = documents.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in text_blocks(batch.column(2)):
                text, start, size, seed, digest = units(data, offsets, window, group)
                n = high - low
                bounds = pa.array(np.searchsorted(text, np.arange(n + 1)).astype(np.int32))
                arrays = [as_longs(seed), as_longs(digest), start.astype(np.int32), size.astype(np.int32)]
                out = pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(low, n) for c in (0, 1)]
                    + [pa.ListArray.from_arrays(bounds, pa.array(a)) for a in arrays],
                    names=["id", "digest", "seeds", "shas", "starts", "sizes"],
                )
                yield out.filter(pa.array(np.diff(np.asarray(bounds)) > 0))

    schema = f"id {kind}, digest long, seeds array<long>, shas array<long>, starts array<int>, sizes array<int>"
    return in_arrow(documents.select("id", "digest", "text"), run, schema)


def repeated_places(documents: DataFrame, window: int, group: int) -> DataFrame:
    """Units whose seed occurs twice or more: ``seed``, ``sha``, ``id``, ``digest``, ``start``, ``size``. Written once."""
    arrays = pin(_unit_arrays(documents, window, group), "units")
    seeds = arrays.select(F.explode("seeds").alias("seed")).groupBy("seed").count().where("count > 1").select("seed")
    seeds = pin(seeds, "seeds")
    tidy(documents.sparkSession)
    zipped = F.arrays_zip(
        F.col("seeds").alias("seed"), F.col("shas").alias("sha"), F.col("starts").alias("start"), F.col("sizes").alias("size")
    )
    places = pin(arrays.select("id", "digest", F.inline(zipped)).join(seeds, "seed", "left_semi"), "places")
    unpin(arrays, seeds)
    return places


def first_places(places: DataFrame) -> DataFrame:
    """One row per distinct unit: ``no``, ``seed``, ``sha``, ``first`` place, ``size``, ``copies``. Written once.

    ``no`` follows the order of first places, and units of a document don't overlap:
    windows are in the order of (``no``, place in the unit).
    """
    spark = places.sparkSession
    place = F.struct(F.col("id").isNull().alias("none"), "id", "digest", F.col("start").alias("pos"))
    firsts = places.groupBy("seed", "sha").agg(
        F.min(place).alias("first"), F.min("size").alias("size"), F.count("*").alias("copies")
    )
    found = pin(firsts, "firsts")
    tidy(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = found.repartitionByRange(parts, "first").sortWithinPartitions("first")
    numbered = pin(dealt.withColumn("no", F.monotonically_increasing_id()), "numbered")
    unpin(found)
    return numbered


def contents(firsts: DataFrame, documents: DataFrame, window: int) -> DataFrame:
    """``no``, ``seed``, ``copies``, ``words`` (as written) and ``hashes`` of the windows of each distinct unit."""
    wanted = firsts.groupBy(F.col("first.id").alias("of"), F.col("first.digest").alias("of_digest")).agg(
        F.collect_list(F.struct("no", "seed", F.col("first.pos").alias("start"), "size", "copies")).alias("units")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in text_blocks(batch.column(0)):
                n = high - low
                found = words(data, offsets, fold=None)
                hashes = window_hashes(found.hashes, window)
                listed = batch.column(1).slice(low, n)
                of = np.repeat(np.arange(n), np.asarray(listed.value_lengths()))
                no, seed, start, size, copies = (np.asarray(c) for c in listed.flatten().flatten())
                first = found.first[of] + start
                begin, end = found.start[first], found.end[first + size + window - 2]
                raw = data.tobytes()
                said = pa.array([raw[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)], pa.binary())
                ends = np.concatenate([[0], np.cumsum(size)])
                at = np.arange(int(ends[-1])) + np.repeat(first - ends[:-1], size)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[pa.array(x) for x in (no, seed, copies)],
                        said.view(pa.string()),
                        pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(as_longs(hashes[at]))),
                    ],
                    names=["no", "seed", "copies", "words", "hashes"],
                )

    on = documents["id"].eqNullSafe(F.col("of")) & (documents["digest"] == F.col("of_digest"))
    given = documents.join(wanted, on).select("text", "units")
    return in_arrow(given, run, "no long, seed long, copies long, words string, hashes array<long>")


#: Windows of a unit are told apart by so many bits.
BITS = 5


def reference(known: DataFrame) -> DataFrame:
    """``of`` (a content's ``no``) and ``marks``: its windows that occur twice or more and have their first place there."""
    each = known.select("no", "copies", F.posexplode("hashes").alias("mark", "hash"))
    order = F.shiftleft("no", BITS) + F.col("mark")
    found = each.groupBy("hash").agg(F.min(order).alias("first"), F.sum("copies").alias("times")).where("times > 1")
    of, mark = F.shiftright("first", BITS).alias("of"), F.col("first").bitwiseAND((1 << BITS) - 1).cast("int")
    return found.groupBy(of).agg(F.sort_array(F.collect_set(mark)).alias("marks"))


class Automaton:
    """Suffix automaton of several word sequences, with the place at which each of its words ends first."""

    def __init__(self):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length, self.end = [-1], [0], [None]

    def _state(self, after: dict, link: int, length: int, end) -> int:
        self.next.append(after)
        self.link.append(link)
        self.length.append(length)
        self.end.append(end)
        return len(self.next) - 1

    def _split(self, p: int, q: int, word: bytes) -> int:
        """The state of the longest word of ``p`` and ``word``, cut out of ``q``."""
        if self.length[q] == self.length[p] + 1:
            return q
        cut = self._state(self.next[q].copy(), self.link[q], self.length[p] + 1, self.end[q])
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = cut
            p = self.link[p]
        self.link[q] = cut
        return cut

    def add(self, sequence: list[bytes], places: list) -> None:
        """Add a sequence; ``places`` say where each of its words is."""
        following, link, length = self.next, self.link, self.length
        last = 0
        for word, place in zip(sequence, places, strict=True):
            known = following[last].get(word)
            if known is not None:
                last = self._split(last, known, word)
                continue
            new = self._state({}, 0, length[last] + 1, place)
            p = last
            while p >= 0 and word not in following[p]:
                following[p][word] = new
                p = link[p]
            if p >= 0:
                link[new] = self._split(p, following[p][word], word)
            last = new

    def statistics(self, sequence: list[bytes], threshold: int) -> Iterator[tuple[int, object]]:
        """Per word: length of the longest match that ends there, and where its last ``threshold`` words first end."""
        following, link, length = self.next, self.link, self.length
        state = matched = 0
        for word in sequence:
            while state and word not in following[state]:
                state = link[state]
                matched = length[state]
            if word in following[state]:
                state = following[state][word]
                matched += 1
            if matched < threshold:
                yield matched, None
                continue
            own = state
            while length[link[own]] >= threshold:
                own = link[own]
            yield matched, self.end[own]


def runs(marks: list[int]) -> Iterator[tuple[int, int]]:
    """First and last of the runs of consecutive numbers."""
    first = before = None
    for mark in marks:
        if first is None:
            first = mark
        elif mark != before + 1:
            yield first, before
            first = mark
        before = mark
    if first is not None:
        yield first, before


def judged(known: DataFrame, window: int) -> DataFrame:
    """Per content (``no``) ``matched`` and ``earlier``: bits of its windows that are in the reference, and
    that start before there."""
    marks = pin(reference(known), "reference")
    tidy(known.sparkSession)
    total = marks.agg(F.sum(F.size("marks"))).first()[0] or 0
    shard = F.pmod(F.xxhash64("seed"), F.lit(1 + total // SHARD)).alias("shard")
    same = F.col("no") == F.col("of")
    held = F.coalesce(F.when(F.size("marks") > 0, F.size("marks")), F.lit(0))
    loads = known.select("no", shard).join(marks, same, "left").groupBy("shard").agg(
        F.sum(held).alias("held"), F.count("*").alias("asked")
    )
    loads = loads.select(
        F.col("shard").alias("at"),
        (F.col("held") / F.lit(2 * SHARD)).cast("long").alias("parts"),
        (F.col("asked") / F.lit(SLICE)).cast("long").alias("slices"),
    )
    loads = pin(loads, "loads")
    rows = known.select("no", shard, F.pmod(F.xxhash64("no"), F.lit(1 << 30)).alias("salt"), "words")
    rows = rows.join(loads, F.col("shard") == F.col("at")).join(marks, same, "left")
    every = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n))
    one = lambda n: F.array(F.pmod("salt", F.col(n) + 1))
    # A content is asked of every part of its shard; one with marks also belongs to a part, in every slice.
    deal = lambda part, piece, kept: F.transform(
        F.flatten(F.transform(part, lambda p: F.transform(piece, lambda s: F.struct(p.alias("part"), s.alias("slice"))))),
        lambda x: F.struct(x["part"].alias("part"), x["slice"].alias("slice"), kept.alias("marks")),
    )
    none = F.lit(None).cast("array<int>")
    asked = deal(every("parts"), one("slices"), none)
    kept = F.when(F.col("marks").isNotNull(), deal(one("parts"), every("slices"), F.col("marks")))
    both = F.concat(asked, F.coalesce(kept, F.array().cast("array<struct<part:long,slice:long,marks:array<int>>>")))
    dealt = rows.select("shard", "no", "words", F.inline(both)).select("shard", "part", "slice", "no", "words", "marks")
    dealt = dealt.repartition("shard", "part", "slice").sortWithinPartitions(
        "shard", "part", "slice", F.col("marks").isNull(), "no"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, automaton = None, Automaton()
        for batch in batches:
            numbers, matched, earlier = [], [], []
            columns = [c.to_pylist() for c in batch.columns]
            for at, part, piece, no, said, marked in zip(*columns, strict=True):
                if (at, part, piece) != of:
                    of, automaton = (at, part, piece), Automaton()
                sequence, base = said.encode().split(), no << BITS
                if marked is not None:
                    for low, high in runs(marked):
                        ends = range(base + low - window + 1, base + high + 1)
                        automaton.add(sequence[low : high + window], ends)
                    continue
                hit = before = 0
                for i, (_, place) in enumerate(automaton.statistics(sequence, window)):
                    if place is not None:
                        mark = i - window + 1
                        hit |= 1 << mark
                        before |= (place < base + mark) << mark
                if hit:
                    numbers.append(no)
                    matched.append(hit)
                    earlier.append(before)
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int64()), pa.array(matched, pa.int32()), pa.array(earlier, pa.int32())],
                names=["no", "matched", "earlier"],
            )

    found = in_arrow(dealt, run, "no long, matched int, earlier int")
    return found.groupBy("no").agg(F.bit_or("matched").alias("matched"), F.bit_or("earlier").alias("earlier"))


def removed_windows(documents: DataFrame, window: int, group: int) -> DataFrame:
    """Per document (``of``, ``of_digest``) that loses words: ``spans``, first windows of units and bits of those that go."""
    places = repeated_places(documents, window, group)
    firsts = first_places(places)
    known = pin(contents(firsts, documents, window), "contents")
    tidy(documents.sparkSession)
    verdicts = judged(known, window).join(firsts.select("no", "sha", "first"), "no").drop("no")
    verdicts = pin(verdicts, "verdicts")
    unpin(known, firsts)
    place = F.struct(F.col("id").isNull().alias("none"), "id", "digest", F.col("start").alias("pos"))
    bits = F.when(place == F.col("first"), F.col("earlier")).otherwise(F.col("matched"))
    lost = places.join(verdicts, "sha").select("id", "digest", "start", bits.alias("bits")).where("bits <> 0")
    spans = lost.groupBy(F.col("id").alias("of"), F.col("digest").alias("of_digest")).agg(
        F.collect_list(F.struct("start", "bits")).alias("spans")
    )
    spans = pin(spans, "spans")
    unpin(places, verdicts)
    return spans


def deduplicated(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20, group: int = 6
) -> DataFrame:
    """Per row: id, the kept words joined by one space as text, ``n_words``, ``n_removed`` and ``kept_sha256``.

    ``window`` less ``group`` is at most 30. ``documents`` is read three times, and
    all but the last step is done when this returns.
    """
    if not 0 <= window - group <= 30:
        raise ValueError("window less group must be 0 to 30")
    given = documents.select(
        F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("digest"), F.col(text_col).alias("text")
    )
    kind = given.schema["id"].dataType.simpleString()
    gone = removed_windows(given, window, group)
    same = given["id"].eqNullSafe(F.col("of")) & (given["digest"] == F.col("of_digest"))
    rows = given.join(gone, same, "left").select("id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for text, spans in zip(batch.column(1), batch.column(2), strict=True):
                found = (text.as_py() or "").encode().split()
                n = len(found)
                if spans.is_valid:
                    covers = np.zeros(n + 1, np.int64)
                    for span in spans.as_py():
                        for i in range(span["bits"].bit_length()):
                            if span["bits"] >> i & 1:
                                covers[span["start"] + i] += 1
                                covers[span["start"] + i + window] -= 1
                    stays = np.cumsum(covers[:-1]) == 0
                    found = [found[i] for i in np.flatnonzero(stays).tolist()]
                kept = b" ".join(found)
                for column, value in zip(out, (kept, n, n - len(found), hashlib.sha256(kept).hexdigest()), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(out[0], pa.binary()).view(pa.string()),
                    pa.array(out[1], pa.int64()),
                    pa.array(out[2], pa.int64()),
                    pa.array(out[3]),
                ],
                names=["id", "text", "n_words", "n_removed", "kept_sha256"],
            )

    schema = f"id {kind}, text string, n_words long, n_removed long, kept_sha256 string"
    found = in_arrow(rows, run, schema)
    return found.select(F.col("id").alias(id_col), F.col("text").alias(text_col), "n_words", "n_removed", "kept_sha256")
