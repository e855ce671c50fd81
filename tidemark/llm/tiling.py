"""Benchmark decontamination by greedy string tiling.

Texts and benchmark items are words in lower case without ASCII punctuation. Runs
of ``least`` words that a text shares with an item are the seeds. Around a text's
seeds, running Karp-Rabin finds the longest common run of words that touches no
marked word, marks it in both as a tile, and goes on with shorter ones down to
``least``. Tiles may lie in any order, so that a reordered passage is covered as
well. A text is contaminated by an item when its tiles cover at least
``min_coverage`` of the item's words.

Items with fewer than ``least`` words are seeds as a whole. NULL texts and items
without words match nothing. Repeated rows and items each have rows of their own.
Items are read in blocks of bounded size, one pass over the texts for each; the driver
holds one block at a time.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import IS_SPACE, in_arrow, shingles, text_blocks, words
from tidemark.workspace import pin

#: Bytes of benchmark text in a block, which is broadcast.
BLOCK_BYTES = 16 << 20
#: ASCII characters that end a word: all but letters and digits.
BETWEEN = IS_SPACE.copy()
BETWEEN[[b for b in range(128) if not chr(b).isalnum()]] = True

Tile = tuple[int, int, int]


def greedy_tiles(item: list[int], text: list[int], least: int) -> list[Tile]:
    """Tiles (place in ``item``, place in ``text``, words), found longest first.

    Of equally long ones the first in the item, then in the text, is taken.
    """
    marked_item, marked_text = [False] * len(item), [False] * len(text)
    tiles: list[Tile] = []
    size = max(least, len(item) // 2)
    while True:
        longest, found = _scan(item, text, marked_item, marked_text, size)
        if longest > 2 * size:
            size = longest
            continue
        for length in range(longest, size - 1, -1):
            for i, j in sorted(set(found[length])):
                free = [not (marked_item[i + k] or marked_text[j + k]) for k in range(length)]
                if all(free):
                    marked_item[i : i + length] = marked_text[j : j + length] = [True] * length
                    tiles.append((i, j, length))
                    continue
                # What is left of it is shorter, so that its turn is still to come.
                for is_free, run in groupby(range(length), key=free.__getitem__):
                    run = list(run)
                    if is_free and len(run) >= size:
                        found[len(run)].append((i + run[0], j + run[0]))
        if not longest:
            if size <= least:
                return tiles
            size = max(least, size // 2)


def _scan(item, text, marked_item, marked_text, size):
    """The longest common unmarked run, and all maximal ones of at least ``size`` by length."""
    places = defaultdict(list)
    for j, value in _windows(text, marked_text, size):
        places[value].append(j)
    longest, found = 0, defaultdict(list)
    for i, value in _windows(item, marked_item, size):
        for j in places.get(value, ()):
            if i and j and item[i - 1] == text[j - 1] and not (marked_item[i - 1] or marked_text[j - 1]):
                continue  # part of the run that begins before
            k = 0
            while (
                i + k < len(item)
                and j + k < len(text)
                and item[i + k] == text[j + k]
                and not (marked_item[i + k] or marked_text[j + k])
            ):
                k += 1
            if k >= size:
                found[k].append((i, j))
                longest = max(longest, k)
    return longest, found


_BASE, _PRIME = 1_000_003, (1 << 61) - 1


def _windows(values: list[int], marked: list[bool], size: int) -> Iterator[tuple[int, int]]:
    """Start and rolling hash of every unmarked window of ``size``."""
    drop = pow(_BASE, size, _PRIME)
    rolled = run = 0
    for at, value in enumerate(values):
        if marked[at]:
            rolled = run = 0
            continue
        rolled = (rolled * _BASE + value) % _PRIME
        run += 1
        if run > size:
            rolled = (rolled - values[at - size] * drop) % _PRIME
        if run >= size:
            yield at - size + 1, rolled


@dataclass
class Block:
    """Benchmark items with their seeds: for each size of seed the sorted hashes and the items that have them."""

    ids: list
    words: list[list[int]]
    seeds: dict[int, tuple[np.ndarray, np.ndarray]]


def benchmark_block(rows: list[tuple], least: int) -> Block:
    """A block from (item id, text) rows."""
    kept = [(item, text.encode()) for item, text in rows if text]
    offsets = np.concatenate([[0], np.cumsum([len(t) for _, t in kept])]).astype(np.int64)
    found = words(np.frombuffer(b"".join(t for _, t in kept), np.uint8), offsets, between=BETWEEN)
    lists = [found.hashes[a:b].tolist() for a, b in zip(found.first[:-1], found.first[1:], strict=True)]
    seeds = {}
    for size in sorted({min(least, len(w)) for w in lists} - {0}):
        values, begins = shingles(found, size, whole_if_short=False)
        owner = np.repeat(np.arange(len(kept)), np.diff(begins))
        fits = np.array([min(least, len(w)) == size for w in lists], bool)[owner]
        values, owner = values[fits], owner[fits]
        order = np.lexsort((owner, values))
        seeds[size] = (values[order], owner[order])
    return Block([i for i, _ in kept], lists, seeds)


def block_matches(block: Block, data: np.ndarray, offsets: np.ndarray, least: int, min_coverage: float) -> list[tuple]:
    """(text, item, words covered, tiles, longest tile) of the texts that contain enough of an item."""
    found = words(data, offsets, between=BETWEEN)
    near: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
    for size, (values, owner) in block.seeds.items():
        windows, begins = shingles(found, size, whole_if_short=False)
        low = np.searchsorted(values, windows)
        hit = np.flatnonzero(values[np.minimum(low, len(values) - 1)] == windows)
        text = np.searchsorted(begins, hit, "right") - 1
        high = np.searchsorted(values, windows[hit], "right")
        for at, t, a, b in zip((hit - begins[text]).tolist(), text.tolist(), low[hit].tolist(), high.tolist(), strict=True):
            for item in dict.fromkeys(owner[a:b].tolist()):
                near[t, item].append((at, size))
    out = []
    for (t, item), hits in sorted(near.items()):
        own = block.words[item]
        # The seeds of a text hold no more words than they could cover.
        if sum(size for _, size in hits) < min_coverage * len(own):
            continue
        first = found.first[t]
        region, end = [], -1
        for at, size in sorted(hits):
            if at > end >= 0:
                region.append(-1)  # a word that is in no item
            start = max(at, end)
            region += found.hashes[first + start : first + at + size].tolist()
            end = max(end, at + size)
        tiles = greedy_tiles(own, region, min(least, len(own)))
        covered = sum(length for _, _, length in tiles)
        if covered >= min_coverage * len(own):
            out.append((t, item, covered, len(tiles), max(length for _, _, length in tiles)))
    return out


def contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    least: int = 5,
    min_coverage: float = 0.6,
) -> DataFrame:
    """Per text and item: ids, ``item_words``, ``covered_words``, ``coverage``, ``n_tiles``, ``longest_tile``."""
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text")).where(F.col("text").isNotNull())
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES) or 1
    kinds = rows.schema[0].dataType.simpleString(), items.schema[0].dataType.simpleString()
    longs = ["item_words", "covered_words", "n_tiles", "longest_tile"]
    schema = f"id {kinds[0]}, item {kinds[1]}, " + ", ".join(f"{c} long" for c in longs)
    names = ["id", "item", *longs]
    types = [None, None, *[pa.int64()] * 4]

    def pass_over(number: int) -> DataFrame:
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == number)
        block = benchmark_block([tuple(r) for r in part.orderBy("item", "text").collect()], least)
        shared = documents.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = shared.value
            for batch in batches:
                kinds_ = [batch.schema.field(0).type, _item_type(known), *types[2:]]
                for low, high, data, offsets in text_blocks(batch.column(1)):
                    found = block_matches(known, data, offsets, least, min_coverage)
                    ids = batch.column(0).slice(low, high - low)
                    columns = [
                        ids.take(pa.array([m[0] for m in found], pa.int64())),
                        pa.array([known.ids[m[1]] for m in found], kinds_[1]),
                        pa.array([len(known.words[m[1]]) for m in found], pa.int64()),
                        *[pa.array([m[k] for m in found], pa.int64()) for k in (2, 3, 4)],
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

        found = in_arrow(rows, run, schema)
        if blocks == 1:
            return found
        # Written before the next block is read: the driver holds one at a time.
        found = pin(found, "tiles")
        shared.unpersist()
        return found

    out = pass_over(0)
    for number in range(1, blocks):
        out = out.union(pass_over(number))
    return out.select(
        F.col("id").alias(id_col),
        F.col("item").alias(item_col),
        "item_words",
        "covered_words",
        (F.col("covered_words") / F.col("item_words")).alias("coverage"),
        "n_tiles",
        "longest_tile",
    )


def _item_type(block: Block) -> pa.DataType:
    return pa.array(block.ids).type if block.ids else pa.int64()
