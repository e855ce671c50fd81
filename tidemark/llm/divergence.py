"""Source divergence audit: how far the term shares of a language's sources lie apart.

Terms are runs of letters: ``A-Z`` (lower-cased), ``a-z`` and everything beyond ASCII.
Tasks count them without a string per term, in buckets by length. Up to 8 bytes are
one big-endian uint64, up to 16 two; both are sorted by radix (16 bits a pass, source
last) and counted as runs. Longer terms go to buckets of doubling width and are sorted
as bytes. A term's documents are counted in the same runs, since the passes keep the
order of texts. Runs of a task's blocks are merged before they leave it.

Spark adds the runs up. A language keeps the terms of at least ``min_documents`` of its
documents. A group (language, source) gives each kept term the share
``1 + scale * (count + pseudo) div (N + pseudo * V)``: ``N`` the group's kept
occurrences, ``V`` the language's kept terms. Shares of a slice of terms form a matrix
of sources, whose rows are compared block by block.

Results are whole numbers and exact. NULL text, language or source is the empty
string; rows with equal columns all count; a group without kept terms has ``N = 0`` and
is compared like any other; a language without kept terms has distances of 0 and no
term rows; equal values are ranked by the item's bytes; no documents give no rows.
A text is worked on whole, however long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import LOWER, in_arrow, text_blocks
from tidemark.workspace import pin

IS_TERM = np.zeros(256, bool)
IS_TERM[0x41:0x5B] = IS_TERM[0x61:0x7B] = IS_TERM[0x80:] = True
#: Bytes of text that are sorted at a time.
BLOCK = 8 << 20
#: Runs that a task holds before it hands them on.
HELD = 1 << 20
#: Shares (source by term) that make a slice, about; and cells of a matrix that is compared at once.
SLICE, CELLS = 200_000, 1 << 21


def radix_order(columns: list[np.ndarray]) -> np.ndarray:
    """Stable order by uint64 ``columns``, the first one most significant: least significant digits first."""
    order = np.arange(len(columns[0]))
    for column in reversed(columns):
        varying = int(np.bitwise_or.reduce(column ^ column[0])) if len(column) else 0
        for shift in range(0, 64, 16):
            if varying >> shift & 0xFFFF:
                digit = (column >> np.uint64(shift)).astype(np.uint16)
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def _changes(columns: list[np.ndarray]) -> np.ndarray:
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return new


class Bucket:
    """Runs of (group, term): occurrences and documents. ``words`` uint64 a term, or byte strings if 0."""

    def __init__(self, words: int):
        self.words = words
        self.runs: list[tuple] = []

    def _order(self, group: np.ndarray, keys: list[np.ndarray]) -> np.ndarray:
        if self.words:
            return radix_order([group, *keys])
        order = np.argsort(keys[0], kind="stable")
        return order[radix_order([group[order]])]

    def count(self, group: np.ndarray, doc: np.ndarray, keys: list[np.ndarray]) -> None:
        """Add terms that stand in the order of ``doc``."""
        order = self._order(group, keys)
        group, doc, keys = group[order], doc[order], [k[order] for k in keys]
        new = _changes([group, *keys])
        at = np.flatnonzero(new)
        other = new.copy()
        other[1:] |= doc[1:] != doc[:-1]
        self.runs.append((
            group[at], [k[at] for k in keys], np.diff(np.append(at, len(group))), np.add.reduceat(other.astype(np.int64), at)
        ))

    def __len__(self) -> int:
        return sum(len(run[0]) for run in self.runs)

    def merge(self) -> None:
        if len(self.runs) < 2:
            return
        group = np.concatenate([r[0] for r in self.runs])
        keys = [np.concatenate(k) for k in zip(*(r[1] for r in self.runs), strict=True)]
        n, docs = (np.concatenate([r[i] for r in self.runs]) for i in (2, 3))
        order = self._order(group, keys)
        group, keys, n, docs = group[order], [k[order] for k in keys], n[order], docs[order]
        at = np.flatnonzero(_changes([group, *keys]))
        self.runs = [(group[at], [k[at] for k in keys], np.add.reduceat(n, at), np.add.reduceat(docs, at))]

    def terms(self) -> pa.Array:
        """The terms of the one merged run: no term holds a zero byte, so that padding drops out."""
        keys = self.runs[0][1]
        if self.words:
            cells = np.stack(keys, axis=1).astype(">u8").view(np.uint8)
        else:
            cells = keys[0].view(np.uint8).reshape(len(keys[0]), -1)
        real = cells != 0
        ends = np.zeros(len(cells) + 1, np.int32)
        np.cumsum(real.sum(axis=1), out=ends[1:])
        return pa.Array.from_buffers(pa.string(), len(cells), [None, pa.py_buffer(ends), pa.py_buffer(cells[real])])


def pack(folded: np.ndarray, start: np.ndarray, length: np.ndarray, words: int) -> list[np.ndarray]:
    """Terms of at most ``8 * words`` bytes as that many big-endian uint64, zeros behind. ``folded`` ends in 16 spare bytes."""
    at = np.ndarray((len(folded) - 7,), ">u8", buffer=folded, strides=(1,))
    out = []
    for k in range(words):
        bits = (8 * np.clip(8 - (length - 8 * k), 0, 8)).astype(np.uint64)
        out.append(at[start + 8 * k].astype(np.uint64) >> bits << bits)
    return out


def as_bytes(folded: np.ndarray, start: np.ndarray, length: np.ndarray, width: int) -> np.ndarray:
    """Terms of at most ``width`` bytes as fixed byte strings."""
    cells = np.zeros((len(start), width), np.uint8)
    row = np.repeat(np.arange(len(start)), length)
    column = np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)
    cells[row, column] = folded[start[row] + column]
    return cells.view(f"S{width}").ravel()


class Counts:
    """Term counts of a task, by group and length bucket (16 bytes and less by words, then doubling widths)."""

    def __init__(self):
        self.buckets = {8: Bucket(1), 16: Bucket(2)}
        self.groups: dict[tuple[str, str], int] = {}

    def add(self, data: np.ndarray, offsets: np.ndarray, group: np.ndarray) -> None:
        """Count the terms of the texts between ``offsets``, each of a ``group``."""
        n = len(data)
        inside = np.zeros(n + 2, bool)
        inside[1:-1] = IS_TERM[data]
        first, last = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
        cuts = offsets[(offsets > 0) & (offsets < n)]
        first[cuts] = inside[1:-1][cuts]
        last[cuts - 1] = inside[1:-1][cuts - 1]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        length = end - start
        doc = np.searchsorted(offsets, start, "right") - 1
        folded = np.concatenate([LOWER[data], np.zeros(16, np.uint8)])
        widths = np.full(len(start), 8)
        while (short := widths < length).any():
            widths[short] *= 2
        for width in np.unique(widths):
            of = np.flatnonzero(widths == width)
            bucket = self.buckets.setdefault(int(width), Bucket(0))
            if bucket.words:
                keys = pack(folded, start[of], length[of], bucket.words)
            else:
                keys = [as_bytes(folded, start[of], length[of], int(width))]
            bucket.count(group[doc[of]].astype(np.uint64), doc[of], keys)

    def held(self) -> int:
        return sum(map(len, self.buckets.values()))

    def merge(self) -> None:
        for bucket in self.buckets.values():
            bucket.merge()

    def flush(self) -> Iterator[pa.RecordBatch]:
        """Hand on all counts and forget them, a bucket at a time."""
        self.merge()
        names = list(self.groups)
        for bucket in self.buckets.values():
            if bucket.runs and len(bucket):
                group, _, n, docs = bucket.runs[0]
                columns = [pa.array([name[i] for name in names], pa.string()).take(pa.array(group)) for i in (0, 1)]
                columns += [bucket.terms(), pa.array(n.astype(np.int64)), pa.array(docs)]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])
            bucket.runs = []


def term_counts(documents: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``term``, ``n``, ``docs`` of frames of (lang, source, text), added up over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts()
        for batch in batches:
            pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            group = np.array([counts.groups.setdefault(p, len(counts.groups)) for p in pairs], np.int64)
            for low, high, data, offsets in text_blocks(batch.column(2), BLOCK):
                counts.add(data, offsets, group[low:high])
            if counts.held() > 2 * HELD:
                counts.merge()
                if counts.held() > HELD:
                    yield from counts.flush()
        yield from counts.flush()

    found = in_arrow(documents, run, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, terms: Column, pseudo: int, scale: int) -> Column:
    """``1 + scale * (count + pseudo) div (total + pseudo * terms)``, in decimals that can't overflow."""
    up = F.lit(scale).cast("decimal(10,0)") * (count + F.lit(pseudo)).cast("decimal(20,0)")
    down = (total + F.lit(pseudo) * terms).cast("decimal(20,0)")
    return F.lit(1).cast("long") + F.floor(F.call_function("div", up, F.when(down > 0, down)))


def _distances(table: pd.DataFrame) -> pd.DataFrame:
    """Per pair of sources the sum of the distances of their shares, over one slice of a language's terms.

    Rows without a term hold the share that a source gives to a term it lacks.
    """
    absent = table[table["term"].isna()].sort_values("source_no")
    there = table[table["term"].notna()]
    n = len(absent)
    codes, terms = pd.factorize(there["term"])
    place = np.searchsorted(absent["source_no"].to_numpy(), there["source_no"].to_numpy())
    shares, base = there["p"].to_numpy(np.int64), absent["p"].to_numpy(np.int64)
    total = np.zeros((n, n), np.int64)
    wide = max(1, CELLS // max(n, 1))
    order = np.argsort(codes, kind="stable")
    bounds = np.searchsorted(codes[order], np.arange(0, len(terms) + wide, wide))
    for k in range(len(bounds) - 1):
        own = order[bounds[k] : bounds[k + 1]]
        matrix = np.repeat(base[:, None], min(wide, len(terms) - k * wide), axis=1)
        matrix[place[own], codes[own] - k * wide] = shares[own]
        for a in range(n - 1):
            total[a, a + 1 :] += np.abs(matrix[a + 1 :] - matrix[a]).sum(axis=1)
    a, b = np.triu_indices(n, 1)
    numbers = absent["source_no"].to_numpy()
    return pd.DataFrame({"lang": table["lang"].iloc[0], "a": numbers[a], "b": numbers[b], "part": total[a, b]})


def audited(
    documents: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_documents: int = 30,
    pseudo: int = 5,
    scale: int = 1_000_000_000,
    top: int = 50,
) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``.

    Part ``pair``: each other source of the language with the summed distance of the
    shares. Part ``term``: the ``top`` terms of the group whose share lies furthest above
    the language's. Ranks start at 1, values descending, then by the item's bytes.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    given = documents.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).alias("text"))
    counted = pin(term_counts(given), "terms")
    kept = counted.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
    kept = pin(kept.where(F.col("docs") >= min_documents).drop("docs"), "kept")
    there = counted.select("lang", "source", "term", "n").join(kept, ["lang", "term"])
    sizes = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    totals = there.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("cells"))
    groups = given.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
    by_lang = Window.partitionBy("lang").orderBy("source")
    groups = pin(
        groups.na.fill(0, ["total", "cells", "terms", "lang_total"])
        .withColumn("source_no", F.row_number().over(by_lang))
        .withColumn("absent", share(F.lit(0), F.col("total"), F.col("terms"), pseudo, scale)),
        "groups",
    )
    cells = groups.agg(F.sum("cells")).first()[0] or 0
    slices = 1 + cells // SLICE
    shares = pin(
        there.join(groups, ["lang", "source"]).select(
            "lang", "source", "source_no", "term",
            share(F.col("n"), F.col("total"), F.col("terms"), pseudo, scale).alias("p"),
            share(F.col("lang_n"), F.col("lang_total"), F.col("terms"), pseudo, scale).alias("q"),
            F.pmod(F.xxhash64("term"), F.lit(slices)).alias("slice"),
        ),
        "shares",
    )

    spread = groups.select("lang", "source_no", F.lit(None).cast("string").alias("term"), F.col("absent").alias("p"),
                           F.explode(F.sequence(F.lit(0), F.lit(slices - 1)).cast("array<long>")).alias("slice"))
    cells_ = spread.where(F.col("p").isNotNull()).unionByName(shares.select("lang", "source_no", "term", "p", "slice"))
    parts = cells_.groupBy("lang", "slice").applyInPandas(_distances, "lang string, a int, b int, part long")
    apart = parts.groupBy("lang", "a", "b").agg(F.sum("part").alias("value"))
    both = apart.unionByName(apart.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    left = groups.select("lang", "source", F.col("source_no").alias("a"))
    right = groups.select("lang", F.col("source").alias("item"), F.col("source_no").alias("b"))
    pairs = left.join(right, "lang").where(F.col("a") != F.col("b")).join(both, ["lang", "a", "b"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))
    above = shares.where(F.col("p") > F.col("q")).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value")
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(order))
    return ranked(pairs).unionByName(ranked(above).where(F.col("rank") <= top))
