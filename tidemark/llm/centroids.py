"""Language identification by nearest centroid, with rejection by distance.

A text's vector holds its byte bigrams and trigrams, hashed, as normalised TF-IDF.
Each language has several centroids, found by spherical k-means, so that a
language may have several kinds of text. A text gets the language of the centroid
with the largest cosine; if that is below the language's limit, a low quantile of
its training cosines, the row is marked as rejected and its score halved.

Document frequencies cover all training rows. Every language is learned, one
in a task; the driver gets its centroids only. They are fitted on a sample of at
most about ``rows_per_language`` training rows, drawn by a hash of the id; a language
with fewer rows is taken whole. Repeated training rows count as often; of centroids
at one distance the first language's, in the order of their names, is taken.

A text that is NULL or has no letter is ``und`` with score 0. Without training
rows every text is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import in_arrow, text_blocks
from tidemark.llm.features import ROWS, ngram_counts, normalised

DIMS = 2048
UNKNOWN = "und"


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    limits: np.ndarray

    def vectors(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return weighted(ngram_counts(data, offsets, DIMS), self.idf)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return normalised(np.sqrt(counts) * idf)


def small_blocks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Like ``text_blocks``, with few enough texts that their dense vectors are small."""
    for low, _, data, offsets in text_blocks(column):
        n = len(offsets) - 1
        for at in range(0, n, ROWS):
            own = offsets[at : min(at + ROWS, n) + 1]
            yield low + at, low + at + len(own) - 1, data[own[0] : own[-1]], own - own[0]


def document_frequencies(texts: DataFrame, dims: int = DIMS) -> tuple[np.ndarray, int]:
    """Texts that have each cell, and texts, over all rows; each task sends one sum per cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(dims, np.int64), 0
        for batch in batches:
            for low, high, data, offsets in small_blocks(batch.column(0)):
                total += (ngram_counts(data, offsets, dims) > 0).sum(axis=0)
                rows += high - low
        cells = np.append(np.arange(dims), -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells), pa.array(np.append(total, rows))], names=["cell", "n"]
        )

    counts = in_arrow(texts, run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    found = dict(counts.collect())
    return np.array([found.get(k, 0) for k in range(dims)], float), found.get(-1, 0)


def draw(key: Column) -> Column:
    """A number from 0 to 1 that depends on ``key`` only."""
    return F.pmod(F.xxhash64(key, F.lit("draw")), F.lit(1 << 30)) / F.lit(float(1 << 30))


def spherical_means(vectors: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """``k`` centroids by cosine, begun from vectors far from each other."""
    chosen = [normalised(vectors.mean(axis=0, keepdims=True))[0]]
    for _ in range(min(k, len(vectors)) - 1):
        best = np.max(vectors @ np.array(chosen).T, axis=1)
        chosen.append(vectors[np.argmin(best)])
    centroids = np.array(chosen)
    for _ in range(rounds):
        nearest = np.argmax(vectors @ centroids.T, axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, vectors)
        centroids = np.where(sums.any(axis=1, keepdims=True), normalised(sums), centroids)
    return centroids


def fitted(
    training: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    rows_per_language: int = 500,
    centroids_per_language: int = 4,
    quantile: float = 0.005,
) -> Model:
    """A model of the languages of ``training``."""
    rows = training.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")
    ).where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    df, total = document_frequencies(rows.select("text"))
    idf = (np.log((1 + total) / (1 + df)) + 1).astype(np.float32)
    share = rows.groupBy(F.col("lang").alias("of")).agg((F.lit(rows_per_language) / F.count("*")).alias("share"))
    drawn = rows.join(share, F.col("lang") == F.col("of"))
    sample = drawn.where(draw(F.struct("id", F.xxhash64("text"))) < F.col("share")).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in small_blocks(batch.column(1)):
                vectors = weighted(ngram_counts(data, offsets, DIMS), idf).astype(np.float16)
                packed = pa.array([v.tobytes() for v in vectors], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), packed], names=["lang", "v"])

    def learned(table: pd.DataFrame) -> pd.DataFrame:
        # The order of rows must not matter.
        vectors = np.array([np.frombuffer(v, np.float16) for v in sorted(table["v"])], np.float32)
        vectors = vectors[vectors.any(axis=1)]
        if not len(vectors):
            return pd.DataFrame({"lang": [], "means": [], "limit": []})
        means = spherical_means(vectors, centroids_per_language).astype(np.float32)
        limit = float(np.quantile(np.max(vectors @ means.T, axis=1), quantile))
        return pd.DataFrame({"lang": [table["lang"].iloc[0]], "means": [means.tobytes()], "limit": [limit]})

    vectors = in_arrow(sample, run, "lang string, v binary")
    found = vectors.groupBy("lang").applyInPandas(learned, "lang string, means binary, limit double").collect()
    languages, centroids, owner, limits = [], [], [], []
    for lang, means, limit in sorted(found):
        means = np.frombuffer(means, np.float32).reshape(-1, DIMS)
        owner += [len(languages)] * len(means)
        languages.append(lang)
        centroids.append(means)
        limits.append(limit)
    every = np.concatenate(centroids) if centroids else np.zeros((0, DIMS), np.float32)
    return Model(languages, idf, every.astype(np.float32), np.array(owner, int), np.array(limits))


def predicted(documents: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``lang_pred``, ``score`` (0 to 1), ``rejected``."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for low, high, data, offsets in small_blocks(batch.column(1)):
                n = high - low
                texts = batch.column(1).slice(low, n).to_pylist()
                letters = np.array([any(map(str.isalpha, t or "")) for t in texts])
                if known.languages:
                    cosines = known.vectors(data, offsets) @ known.centroids.T
                    nearest = np.argmax(cosines, axis=1)
                    best, which = cosines[np.arange(n), nearest], known.owner[nearest]
                    far = best < known.limits[which]
                    names = [known.languages[w] if has else UNKNOWN for w, has in zip(which, letters, strict=True)]
                    score = np.where(letters, np.clip(best, 0, 1) * np.where(far, 0.5, 1), 0.0)
                else:
                    names, score, far = [UNKNOWN] * n, np.zeros(n), np.ones(n, bool)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, n),
                        pa.array(names, pa.string()),
                        pa.array(score.astype(float)),
                        pa.array(far | ~letters),
                    ],
                    names=["id", "lang_pred", "score", "rejected"],
                )

    out = in_arrow(rows, run, f"id {kind}, lang_pred string, score double, rejected boolean")
    return out.withColumnRenamed("id", id_col)
