"""Quality rules: word and line counts of a text, and line frequency across documents.

Lines are normalised (A-Z lower-cased, digits alike, white space as one space) and
hashed; the documents of a host that contain a line are counted. Lines in more than a
share of the host's documents are taken out of the texts, and a document that loses more
than a share of its words to that is depleted and rejected.

Each row is a document, a repeated one too. NULL is an empty text and fails the
base rules; documents with a NULL host form a host of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import IS_SPACE, LOWER, Words, as_longs, in_arrow, mixed, shingles, sums, text_blocks, words
from tidemark.workspace import pin

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
NEWLINE = np.zeros(256, bool)
NEWLINE[0x0A] = True
#: Lower case, and every digit as 0.
NORMAL = LOWER.copy()
NORMAL[0x30:0x3A] = 0x30
#: Shares by which a hot line's rows are spread in the join that finds them.
SALTS = 16

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: whether it occurs again anywhere, and whether it occurred before."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    again, before = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    again[order[1:]] = same
    before[order[1:]] = same
    again[order[:-1]] |= same
    return again, before


def _own(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Hashes that only agree within a text."""
    return hashes ^ mixed(text.astype(np.uint64) + np.uint64(1))


def real_lines(data: np.ndarray, offsets: np.ndarray, found: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lines that have words, in order: text, hash as written, hash of the normalised line, number of words."""
    lines = words(data, offsets, fold=None, between=NEWLINE)
    line_first = np.searchsorted(found.start, lines.start)
    line_words = np.searchsorted(found.start, lines.end) - line_first
    real = line_words > 0
    normal = words(data, offsets, fold=NORMAL)
    line_first, line_words = line_first[real], line_words[real]
    rank = np.arange(len(normal)) - np.repeat(line_first, line_words)
    spread = mixed(normal.hashes + mixed(rank.astype(np.uint64)))
    hashes = mixed(sums(spread, np.append(line_first, len(normal)))) if len(line_first) else spread
    return lines.text[real], lines.hashes[real], hashes, line_words


def measure(data: np.ndarray, offsets: np.ndarray) -> tuple[dict[str, np.ndarray], tuple]:
    """Counts per text; and text, hash, number of words of its normalised lines, in order."""
    found = words(data, offsets, fold=None)
    counts = {"n_words": np.diff(found.first)}
    starts_char = (data & 0xC0) != 0x80
    counts["word_chars"] = sums(starts_char & ~IS_SPACE[data], offsets)
    counts["n_symbols"] = sums(SYMBOLS[data], offsets)

    windows, begins = shingles(found, 3, whole_if_short=False)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(begins))
    at = np.flatnonzero(_repeated(_own(windows, owner))[0])
    at = at + (found.first[:-1] - begins[:-1])[owner[at]]
    covered = np.zeros(len(found), bool)
    for k in range(3):
        covered[at + k] = True
    counts["n_repeat_words"] = sums(covered, found.first)

    text, written, hashes, line_words = real_lines(data, offsets, found)
    before = _repeated(_own(written, text))[1]
    counts["n_dup_lines"] = sums(before, np.searchsorted(text, np.arange(len(offsets))))
    return counts, (text, hashes, line_words)


def keyed(documents: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """``id``, ``host``, ``text`` and ``digest``: rows that agree in id and digest are the same document."""
    host, text = F.col(host_col).cast("string"), F.col(text_col)
    return documents.select(
        F.col(id_col).alias("id"),
        host.alias("host"),
        text.alias("text"),
        F.xxhash64(F.coalesce(text, F.lit("")), host.isNull(), host).alias("digest"),
    )


def line_hashes(rows: DataFrame) -> DataFrame:
    """Per row of ``keyed``: ``row`` (its number), id, digest, host, and ``lines``, the hashes of its different lines."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for low, high, data, offsets in text_blocks(batch.column(3)):
                text, _, hashes, _ = real_lines(data, offsets, words(data, offsets, fold=None))
                order = np.lexsort((hashes, text))
                text, hashes = text[order], hashes[order]
                new = np.ones(len(text), bool)
                new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
                n = high - low
                bounds = np.searchsorted(text[new], np.arange(n + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(number, number + n)),
                        *[batch.column(c).slice(low, n) for c in range(3)],
                        pa.ListArray.from_arrays(pa.array(bounds), pa.array(as_longs(hashes[new]))),
                    ],
                    names=["row", "id", "digest", "host", "lines"],
                )
                number += n

    schema = f"row long, id {kind}, digest long, host string, lines array<long>"
    return in_arrow(rows.select("id", "digest", "host", "text"), run, schema)


def cut(text: bytes, drop: np.ndarray) -> bytes:
    """``text`` without those of its lines that have words for which ``drop`` is set, in order."""
    kept, place = [], 0
    for line in text.split(b"\n"):
        real = not IS_SPACE[np.frombuffer(line, np.uint8)].all()
        if not (real and drop[place]):
            kept.append(line)
        place += real
    return b"\n".join(kept)


def without_lines(rows: DataFrame) -> DataFrame:
    """Per row of id, text and ``gone`` (hashes of lines): id, text without those lines, the counts, ``n_removed_words``.

    The counts are those of the whole text. A text that loses nothing is handed on as it is.
    """
    kind = rows.schema["id"].dataType.simpleString()
    names = ["id", "text", *COUNTS, "n_removed_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in text_blocks(batch.column(1)):
                n = high - low
                counts, (text, hashes, line_words) = measure(data, offsets)
                texts, gone = batch.column(1).slice(low, n), batch.column(2).slice(low, n)
                owner = np.repeat(np.arange(n), np.asarray(gone.value_lengths().fill_null(0)))
                keys = _own(np.asarray(gone.flatten()).astype(np.int64).view(np.uint64), owner)
                drop = np.isin(_own(hashes, text), keys)
                first = np.searchsorted(text, np.arange(n + 1))
                lost = np.flatnonzero(sums(drop, first))
                if len(lost):
                    held = texts.cast(pa.binary()).to_pylist()
                    for i in lost:
                        held[i] = cut(held[i], drop[first[i] : first[i + 1]])
                    texts = pa.array(held, pa.binary()).view(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, n),
                        texts,
                        *[pa.array(counts[c].astype(np.int64)) for c in COUNTS],
                        pa.array(sums(np.where(drop, line_words, 0), first).astype(np.int64)),
                    ],
                    names=names,
                )

    longs = ", ".join(f"{c} long" for c in names[2:])
    return in_arrow(rows.select("id", "text", "gone"), run, f"id {kind}, text string, {longs}")


def cleaned(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    min_words: int = 50,
    max_repeat_percent: int = 50,
    max_documents: int = 3,
    max_removed_share: float = 0.2,
    max_host_share: float | None = 0.05,
) -> DataFrame:
    """Per row: id, the text without its removed lines, the counts, ``base_failed``, ``n_removed_words``, ``kept``.

    A line is removed if more than ``max_host_share`` of a host's documents have it, so
    that the limit follows a host's size, and more than ``max_documents``, its floor;
    without ``max_host_share`` the floor is the limit.
    A document is rejected if more than ``max_removed_share`` of its words go; the
    counts and ``base_failed`` are those of its whole text. ``documents`` is read twice.
    """
    given = keyed(documents, id_col, text_col, host_col)
    rows = pin(line_hashes(given), "lines")
    lines = rows.select("row", "id", "digest", "host", F.explode("lines").alias("hash"))
    common = (
        lines.groupBy("host", "hash").agg(F.count("*").alias("documents")).where(F.col("documents") > max_documents)
    )
    if max_host_share is not None:
        hosts = rows.groupBy(F.col("host").alias("of")).agg(F.count("*").alias("held"))
        over = F.col("documents") > F.lit(max_host_share) * F.col("held")
        common = common.join(hosts, F.col("host").eqNullSafe(F.col("of"))).where(over).select("host", "hash", "documents")
    # A common line has many rows, so that its copies for the salts are fewer than they.
    salted = common.withColumn("salt", F.explode(F.array(*[F.lit(k) for k in range(SALTS)])))
    spread = lines.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
    on = (
        spread["host"].eqNullSafe(salted["host"]) & (spread["hash"] == salted["hash"]) & (spread["salt"] == salted["salt"])
    )
    gone = (
        spread.join(salted, on)
        .groupBy(spread["id"].alias("of"), spread["digest"].alias("text_digest"))
        .agg(F.collect_set(spread["hash"]).alias("gone"))
    )
    same = given["id"].eqNullSafe(gone["of"]) & (given["digest"] == gone["text_digest"])
    words_ = F.col("n_words")
    failed = (words_ < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * words_)
    return without_lines(given.join(gone, same, "left")).select(
        F.col("id").alias(id_col),
        F.col("text").alias(text_col),
        *COUNTS,
        failed.alias("base_failed"),
        "n_removed_words",
        (~failed & (F.col("n_removed_words") <= max_removed_share * words_)).alias("kept"),
    )


def judged(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", **limits) -> DataFrame:
    """``cleaned`` with these limits, without the text."""
    return cleaned(documents, id_col, text_col, host_col, **limits).drop(text_col)
