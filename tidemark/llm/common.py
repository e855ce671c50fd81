"""What the operators share: reading texts batch by batch, and hashing words.

A word is a run of bytes other than ``\\x20`` and ``\\x09``-``\\x0D``. Words are known
by a 64-bit hash, a polynomial over the bytes modulo 2**64 with random byte
values, mixed at the end. Of a billion different words about 0.03 pairs are
expected to share a hash.
"""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: The folder that holds the package.
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
#: Bytes of text that are worked on at a time. A single longer word is taken whole.
SLICE = 1 << 20
#: Bytes of text whose results are gathered before they are handed on.
BLOCK = 2 << 20
#: Size of the batches that Spark hands to Python: a few long texts make a batch, so
#: that neither side holds many of them. Only set where the session has the default.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "2000"),
    "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "8m"),
}

_rng = np.random.Generator(np.random.PCG64(20240607))
_ODD = np.uint64(_rng.integers(1 << 62, 1 << 63, dtype=np.uint64) * 2 + 3)
_VALUES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(_rng.integers(1 << 62, 1 << 63, dtype=np.uint64) * 2 + 1)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
_powers: dict[str, np.ndarray] = {}


def remainder(column: str | Column, by: int) -> Column:
    """``crc32(column as text) mod by``; -1 for NULL."""
    text = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.coalesce(F.crc32(text.cast("binary")) % F.lit(by), F.lit(-1))


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base of the word hash, and of its inverse."""
    if not _powers or len(_powers["up"]) < n:
        size = max(n, SLICE + 4096)
        down = pow(int(_ODD), -1, 1 << 64)
        for name, base in (("up", _ODD), ("down", np.uint64(down))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


class Words:
    """The words of a block of texts, in order: byte range, text number, hash."""

    def __init__(self, start: np.ndarray, end: np.ndarray, offsets: np.ndarray, hashes: np.ndarray):
        self.start, self.end, self.hashes = start, end, hashes
        #: Word ``first[i]`` up to ``first[i + 1]`` are those of text ``i``.
        self.first = np.searchsorted(start, offsets)

    def __len__(self) -> int:
        return len(self.start)

    @property
    def text(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words(
    data: np.ndarray, offsets: np.ndarray, fold: np.ndarray | None = LOWER, between: np.ndarray = IS_SPACE
) -> Words:
    """The words of the texts that lie in ``data`` between ``offsets``.

    ``fold`` maps bytes before they are hashed, ``between`` marks the bytes that
    end a word.
    """
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    parts = []
    low = 0
    while low < n:
        high = min(n, low + SLICE)
        while high < n and not (edge[high] or between[data[high]]):
            ahead = between[data[high : high + 4096]] | edge[high : min(high + 4096, n)]
            found = np.flatnonzero(ahead)
            high = high + int(found[0]) if len(found) else min(n, high + 4096)
        parts.append(_slice_words(data[low:high], edge[low : high + 1], low, fold, between))
        low = high
    if not parts:
        none = np.zeros(0, np.int64)
        return Words(none, none, offsets, np.zeros(0, np.uint64))
    start, end, hashes = (np.concatenate(x) for x in zip(*parts, strict=True))
    return Words(start, end, offsets, hashes)


def _slice_words(data, edge, shift, fold, between):
    n = len(data)
    inside = ~between[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last[:-1] &= ~inside[1:] | edge[1:n]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = powers(n + 1)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_VALUES[data if fold is None else fold[data]] * up[:n], out=sums[1:])
    hashes = (sums[end] - sums[start]) * down[start]
    hashes ^= (end - start).astype(np.uint64) * _STEP
    return start + shift, end + shift, mixed(hashes)


def shingles(found: Words, size: int, whole_if_short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, in order, and where each text's begin.

    A text with fewer words has one, of all its words, or none if not
    ``whole_if_short``; a text without words has none.
    """
    counts = np.diff(found.first)
    rolled = np.zeros(max(0, len(found) - size + 1), np.uint64)
    factors = np.full(size, _STEP, np.uint64)
    factors[0] = 1
    factors = np.multiply.accumulate(factors)
    for k in range(size):
        rolled += found.hashes[k : k + len(rolled)] * factors[k]
    made = np.maximum(counts - size + 1, 0)
    index = np.arange(int(made.sum())) + np.repeat(
        found.first[:-1] - np.concatenate([[0], np.cumsum(made)[:-1]]), made
    )
    out = mixed(rolled[index])
    begins = np.concatenate([[0], np.cumsum(made)])
    short = np.flatnonzero((counts > 0) & (counts < size)) if whole_if_short else []
    if len(short):
        values = []
        for i in short:
            own = found.hashes[found.first[i] : found.first[i + 1]]
            values.append((own * factors[: len(own)]).sum() ^ (_VALUES[len(own)]))
        out = np.insert(out, begins[short], mixed(np.array(values, np.uint64)))
        begins = np.concatenate([[0], np.cumsum(np.where((counts > 0) & (counts < size), 1, made))])
    return out, begins


def text_blocks(column: pa.Array, limit: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows ``low`` to ``high`` of a text column with their bytes and offsets into them.

    NULL is an empty text. A block holds whole texts of about ``limit`` bytes.
    """
    n = len(column)
    if n == 0:
        return
    binary = column.cast(pa.binary())
    _, ends, data = binary.buffers()
    offsets = np.frombuffer(ends, np.int32)[binary.offset : binary.offset + n + 1].astype(np.int64)
    values = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    low = 0
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
        high = min(high, n)
        yield low, high, values[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` in each of the stretches between ``offsets``."""
    total = np.zeros(len(values) + 1, np.int64 if values.dtype == bool else values.dtype)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def per_batch(
    df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str
) -> DataFrame:
    """Apply ``work`` to each Arrow batch of ``df``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield work(batch)

    return in_arrow(df, run, schema)


def in_arrow(
    df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema
) -> DataFrame:
    """``mapInArrow`` with batches of bounded bytes.

    Workers look for this package also where the driver has it, so that it need
    not be installed where they share that folder; elsewhere ship it with the job.
    Spark keeps workers for further tasks; at a task's end they hand back what it freed.
    """
    environment = df.sparkSession.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
    conf = df.sparkSession.conf
    for key, (default, small) in BATCHES.items():
        if conf.get(key, default) == default:
            conf.set(key, small)
    return df.mapInArrow(_handing_back(run), schema)


def _handing_back(
    run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            hand_back()

    return whole


def hand_back() -> None:
    """Return freed memory to the system, which allocators otherwise keep for the process."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim is not None:
        trim(0)


#: Rows that may be broadcast by their keys; more are joined by a shuffle.
MOST_IDS = 1_000_000


def row_key(id_col: str, text_col: str) -> Column:
    """What tells rows apart: the id, NULL after all others, and a digest of the text."""
    id_ = F.col(id_col)
    return F.struct(id_.isNull().alias("none"), id_.alias("id"), F.xxhash64(F.col(text_col)).alias("digest"))


def unused(name: str, df: DataFrame) -> str:
    """``name`` with as many underscores in front as no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def sent_whole(df: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """``df``, a few numbers a row, to be broadcast in a join if it has so few rows that it may be.

    ``stored`` is a frame with as many rows that is read to count them, if ``df`` is none.
    """
    rows = df if stored is None else stored
    return F.broadcast(df) if rows.limit(MOST_IDS + 1).count() <= MOST_IDS else df


def without(df: DataFrame, keys: DataFrame, id_col: str, text_col: str, how: str = "left_anti") -> DataFrame:
    """Rows of ``df`` whose ``row_key`` is not in ``keys``, a small or stored frame of that one column."""
    few = keys.limit(MOST_IDS + 1).count() <= MOST_IDS
    key = F.col(keys.columns[0])
    own_id, own_digest = unused("id", df), unused("digest", df)
    found = keys.select(key["id"].alias(own_id), key["digest"].alias(own_digest))
    on = F.col(id_col).eqNullSafe(F.col(own_id)) & (F.xxhash64(F.col(text_col)) == F.col(own_digest))
    return df.join(F.broadcast(found) if few else found, on, how)


def as_longs(values: np.ndarray) -> np.ndarray:
    """The same 64 bits as signed numbers, as Spark holds them."""
    return values.view(np.int64)
