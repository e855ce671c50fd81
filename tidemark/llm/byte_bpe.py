"""Byte-level BPE by a sentencepiece model that is written from a rank file.

The rank file's tokens become the pieces of a sentencepiece BPE model: each byte
is mapped to a printable character, the score is the negative rank, and the
normaliser leaves the text as it is. Sentencepiece merges the pair with the best
score first, the leftmost of equals, which is the merge order of the ranks. Each
match of the pre-token pattern is encoded by itself. No tokenizer is trained.

A token is not always reached by merges: a pre-token that is a token as a whole
is that token, as rank files are read. Decoding maps ids back to bytes.
"""

from __future__ import annotations

import base64
import contextlib
import struct
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import in_arrow, per_batch, text_blocks

#: Pre-tokens whose ids a task keeps at hand. When full, it starts anew.
KEPT = 250_000


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where it is one, else one from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | int | float) -> bytes:
    """One protobuf field: a length-delimited, varint or 32-bit float value."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def piece_model(tokens: list[bytes]) -> bytes:
    """A serialised sentencepiece model: piece 0 is ``<unk>``, piece ``r + 1`` the token of rank ``r``."""
    shown = byte_characters()
    normal, unknown, bpe = 1, 2, 2
    pieces = [_field(1, b"<unk>") + _field(2, 0.0) + _field(3, unknown)]
    for rank, token in enumerate(tokens):
        text = "".join(shown[b] for b in token).encode()
        pieces.append(_field(1, text) + _field(2, float(-rank)) + _field(3, normal))
    trainer = _field(3, bpe) + _field(4, len(pieces))
    identity = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(_field(1, p) for p in pieces) + _field(2, trainer) + _field(3, identity)


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank from lines of base64 token and rank; ranks must run from 0 without gaps."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    return [ranks[r] for r in range(len(ranks))]


class Codec(dict):
    """Encodes and decodes with the tokens of a rank file. Holds ids by pre-token."""

    def __init__(self, tokens: list[bytes], pattern: str):
        import regex
        import sentencepiece

        self.tokens = tokens
        self.find = regex.compile(pattern).findall
        self.merge = sentencepiece.SentencePieceProcessor(model_proto=piece_model(tokens)).encode_as_ids
        #: Tokens that are text by themselves; the others can't be a whole pre-token.
        self.whole = {}
        for rank, token in enumerate(tokens):
            with contextlib.suppress(UnicodeDecodeError):
                self.whole[token.decode()] = (rank,)
        self.table = dict(enumerate(byte_characters()))

    def __missing__(self, part: str) -> tuple[int, ...]:
        ids = self.whole.get(part)
        if ids is None:
            pieces = self.merge(part.encode().decode("latin-1").translate(self.table))
            ids = tuple([i - 1 for i in pieces])
        if len(self) >= KEPT:
            self.clear()
        self[part] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.__getitem__, self.find(text))))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def _codec(tokens: tuple[bytes, ...], pattern: str) -> Codec:
    return Codec(list(tokens), pattern)


def shared_vocabulary(spark: SparkSession, path: str, pattern: str) -> Broadcast:
    """The tokens and the pattern for all tasks; a rank file has some 100,000 short entries."""
    return spark.sparkContext.broadcast((tuple(read_ranks(path)), pattern))


def with_tokens(
    df: DataFrame, path: str, pattern: str, text_col: str = "text", ids_col: str = "token_ids"
) -> DataFrame:
    """``df`` with the ids of its texts, an array of int. NULL is the empty text.

    A column of this name is replaced.
    """
    vocabulary = shared_vocabulary(df.sparkSession, path, pattern)
    kept = df.drop(ids_col)
    names = kept.columns
    place = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(*vocabulary.value)
        for batch in batches:
            for low, high, _, _ in text_blocks(batch.column(place)):
                part = batch.slice(low, high - low)
                ids = [codec.encode(t or "") for t in part.column(place).to_pylist()]
                columns = [*part.columns, pa.array(ids, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, ids_col])

    return in_arrow(kept, run, kept.withColumn(ids_col, F.lit(None).cast("array<int>")).schema)


def with_decoded(
    df: DataFrame, path: str, pattern: str, ids_col: str = "token_ids", bytes_col: str = "decoded"
) -> DataFrame:
    """``df`` with the bytes that its ids stand for. NULL ids are none. A column of this name is replaced."""
    vocabulary = shared_vocabulary(df.sparkSession, path, pattern)
    kept = df.drop(bytes_col)
    names = kept.columns
    place = names.index(ids_col)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        tokens = vocabulary.value[0]
        found = [b"".join([tokens[i] for i in ids or ()]) for ids in batch.column(place).to_pylist()]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], names=[*names, bytes_col])

    return per_batch(kept, work, kept.withColumn(bytes_col, F.lit(None).cast("binary")).schema)


def encode_digests(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: number of ids, SHA-256 of the ids in decimal joined by a space, and of the bytes decoded from them.

    The ids and bytes of one text at a time are in memory, none are moved.
    NULL is the empty text: no ids, digests of nothing. Ids repeat as the rows do.
    """
    vocabulary = shared_vocabulary(df.sparkSession, path, pattern)
    rows = df.select(F.col(id_col), F.col(text_col))
    kind = rows.schema[0].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec = _codec(*vocabulary.value)
        counts, id_digests, byte_digests = [], [], []
        decimal = list(map(str, range(len(codec.tokens))))
        texts = batch.column(1)
        for low, high, _, _ in text_blocks(texts):
            for text in texts.slice(low, high - low).to_pylist():
                ids = codec.encode(text or "")
                counts.append(len(ids))
                joined = " ".join(map(decimal.__getitem__, ids))
                id_digests.append(sha256(joined.encode()).hexdigest())
                byte_digests.append(sha256(codec.decode(ids)).hexdigest())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(id_digests), pa.array(byte_digests)],
            names=["id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return per_batch(rows, work, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)
