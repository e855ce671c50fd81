"""Quality classification by nearest labelled neighbours in a latent-semantic space.

A text's terms are its hashed byte n-grams, as TF-IDF, and its shape in bins. A
truncated singular value decomposition of the labelled sample's matrix gives the
latent space. The sample's vectors are broadcast; for every text the cosines to
all of them are computed exactly, a block of texts at a time, and the nearest
vote with their similarity. A vote also weighs what its class was thinned by in
the sample, so that the score estimates a probability in the whole table.

The sample has at most about ``rows_per_class`` rows of each label, drawn by a
hash of the id, so what is broadcast is bounded: some 8,000 vectors of ``RANK``
numbers. A NULL or empty text has only its shape. Without labelled rows every
score is 0.5. Of repeated labels of a document each is a row of the sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.centroids import draw, small_blocks
from tidemark.llm.common import in_arrow
from tidemark.llm.features import BINS, SHAPES, ngram_counts, normalised, shape_vectors

DIMS = 2048
RANK = 48
#: How much a text's shape weighs against its n-grams.
SHAPE_WEIGHT = 1.0


@dataclass
class Model:
    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    weights: np.ndarray
    nearest: int


def counted(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    # The n-grams see upper case and marks as they are.
    return np.hstack([ngram_counts(data, offsets, DIMS, fold=None), shape_vectors(data, offsets)])


def terms(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    grams = normalised(np.sqrt(counts[:, :DIMS]) * idf)
    shape = normalised(counts[:, DIMS:])
    return np.hstack([grams, SHAPE_WEIGHT * shape]).astype(np.float32)


def latent_axes(matrix: np.ndarray, rank: int) -> np.ndarray:
    """The leading right singular vectors, by subspace iteration."""
    rng = np.random.Generator(np.random.PCG64(11))
    rank = min(rank, *matrix.shape)
    basis = rng.standard_normal((matrix.shape[1], min(rank + 8, *matrix.shape))).astype(np.float32)
    for _ in range(8):
        basis, _ = np.linalg.qr(matrix.T @ (matrix @ basis))
    _, _, right = np.linalg.svd(matrix @ basis, full_matrices=False)
    return (basis @ right.T)[:, :rank].astype(np.float32)


def labelled_sample(
    documents: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows_per_class: int
) -> tuple[DataFrame, dict[int, float]]:
    """Label and text of about ``rows_per_class`` labelled rows of each class, and the shares drawn.

    The rows are drawn from the labels alone, by a hash of the id, so that only
    their bounded number is broadcast to where the texts are.
    """
    rows = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & F.col("id").isNotNull()
    )
    sizes = dict(rows.groupBy("label").count().collect())
    share = {k: min(1.0, rows_per_class / max(1, sizes.get(k, 0))) for k in (0, 1)}
    wanted = F.when(F.col("label") == 1, share[1]).otherwise(share[0])
    drawn = F.broadcast(rows.where(draw(F.struct("id")) < wanted))
    texts = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return texts.join(drawn, "id").select("label", "text"), share


def fitted(
    documents: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    rows_per_class: int = 2000,
    nearest: int = 15,
) -> Model:
    """A model of the texts whose ids have a label of 0 or 1 in ``labels``; other labels are passed over."""
    sample, share = labelled_sample(documents, labels, id_col, text_col, label_col, rows_per_class)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in small_blocks(batch.column(1)):
                packed = pa.array([v.astype(np.float32).tobytes() for v in counted(data, offsets)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), packed], names=["label", "v"])

    found = [(label, np.frombuffer(v, np.float32)) for label, v in in_arrow(sample, run, "label int, v binary").collect()]
    found.sort(key=lambda x: (x[0], x[1].tobytes()))
    labels = np.array([label for label, _ in found], np.float32)
    counts = np.array([v for _, v in found], np.float32).reshape(len(found), DIMS + SHAPES * BINS)
    del found
    df = (counts[:, :DIMS] > 0).sum(axis=0)
    idf = (np.log((1 + len(counts)) / (1 + df)) + 1).astype(np.float32)
    matrix = terms(counts, idf)
    axes = latent_axes(matrix, RANK) if len(matrix) else np.zeros((matrix.shape[1], 1), np.float32)
    weights = np.where(labels == 1, 1 / share[1], 1 / share[0]).astype(np.float32)
    return Model(idf, axes, normalised(matrix @ axes), labels, weights, nearest)


def votes(model: Model, counts: np.ndarray) -> np.ndarray:
    """Per text the share of the similar labelled texts' weight that is of label 1."""
    if not len(model.vectors):
        return np.full(len(counts), 0.5)
    cosines = normalised(terms(counts, model.idf) @ model.axes) @ model.vectors.T
    k = min(model.nearest, cosines.shape[1])
    near = np.argpartition(cosines, cosines.shape[1] - k, axis=1)[:, -k:]
    similar = np.maximum(np.take_along_axis(cosines, near, axis=1), 1e-6) ** 4 * model.weights[near]
    return (similar * model.labels[near]).sum(axis=1) / similar.sum(axis=1)


def scored(documents: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``documents`` but a ``score``, with ``score`` (0 to 1).

    Texts are read by their column's name only; ``id_col`` is for the caller.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)
    kept = documents.drop("score")
    names = kept.columns
    place = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for low, high, data, offsets in small_blocks(batch.column(place)):
                score = np.clip(votes(known, counted(data, offsets)), 0, 1).astype(float)
                columns = [c.slice(low, high - low) for c in batch.columns]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(score)], names=[*names, "score"])

    return in_arrow(kept, run, kept.withColumn("score", F.lit(None).cast("double")).schema)
