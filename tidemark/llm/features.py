"""Vectors of texts: hashed byte n-grams, and the shape of a text."""

from __future__ import annotations

import numpy as np

from tidemark.llm.common import IS_SPACE, mixed, sums, words

#: Texts whose dense vectors are held at a time.
ROWS = 256

#: A-Z lower-cased, every other ASCII byte that is no letter as a space.
LETTERS = np.full(256, 0x20, np.uint8)
LETTERS[0x61:0x7B] = np.arange(0x61, 0x7B)
LETTERS[0x41:0x5B] = np.arange(0x61, 0x7B)
LETTERS[0x80:] = np.arange(0x80, 0x100)


def _cells(codes: np.ndarray, dims: int) -> np.ndarray:
    return ((codes * np.uint32(2654435761)) >> np.uint32(32 - int(dims).bit_length() + 1)).astype(np.int64)


def ngram_counts(data: np.ndarray, offsets: np.ndarray, dims: int, fold: np.ndarray | None = LETTERS) -> np.ndarray:
    """Counts of the byte bigrams and trigrams of each text in ``dims`` (a power of two) cells."""
    n = len(offsets) - 1
    out = np.zeros((n, dims), np.float32)
    folded = data if fold is None else fold[data]
    for i in range(n):
        text = folded[offsets[i] : offsets[i + 1]]
        for low in range(0, len(text), 1 << 20):
            part = text[low : low + (1 << 20) + 2].astype(np.uint32)
            two = part[:-1] | part[1:] << np.uint32(8)
            three = two[:-1] | part[2:] << np.uint32(16)
            last = low + (1 << 20) >= len(text)
            two = two if last else two[: 1 << 20]
            codes = np.concatenate([two, three[: 1 << 20] | np.uint32(1 << 24)])
            out[i] += np.bincount(_cells(codes, dims), minlength=dims)
    return out


def normalised(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; a row of zeros stays."""
    size = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]
    return vectors / np.where(size > 0, size, 1)


SHAPES = 9
BINS = 8


def _class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_UPPER = _class(bytes(range(0x41, 0x5B)))
_DIGIT = _class(b"0123456789")
_MARK = _class(b"#*$%&|<>=+~^{}[]\\/_@")
_CRY = _class(b"!?")
_STOP = _class(b".,;:")


def shape_vectors(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The shape of each text: shares of kinds of characters and of repeated words, in bins."""
    found = words(data, offsets)
    n = len(offsets) - 1
    chars = np.maximum(np.diff(offsets), 1)
    count = np.diff(found.first)
    known = np.maximum(count, 1)
    text = found.text
    keys = found.hashes ^ mixed(text.astype(np.uint64) + np.uint64(1))
    distinct = np.bincount(text[np.unique(keys, return_index=True)[1]], minlength=n) if len(keys) else np.zeros(n)
    twice = np.zeros(len(found), bool)
    twice[1:] = (found.hashes[1:] == found.hashes[:-1]) & (text[1:] == text[:-1])
    share = lambda kind: sums(kind[data], offsets) / chars
    # Repetition is measured against what a text of this length would have.
    values = [
        distinct / known ** 0.85,
        sums(twice, found.first) / known * 4,
        share(_UPPER) * 4,
        share(_DIGIT) * 4,
        share(_MARK) * 6,
        share(_CRY) * 10,
        share(_STOP) * 10,
        sums(~IS_SPACE[data], offsets) / known / 12,
        np.log2(known) / 16,
    ]
    out = np.zeros((n, SHAPES, BINS), np.float32)
    for k, value in enumerate(values):
        at = np.clip(value, 0, 1) * (BINS - 1)
        low = np.minimum(at.astype(int), BINS - 2)
        out[np.arange(n), k, low] = 1 - (at - low)
        out[np.arange(n), k, low + 1] = at - low
    return out.reshape(n, SHAPES * BINS)
