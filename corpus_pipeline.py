"""From raw documents to token ids: quality, near copies, benchmark leaks, secrets, encoding.

Each stage is written to the shared folder and read again by the next one. A
learned stage is fitted on what it gets.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import byte_bpe, jaccard_join, neighbours, secret_scan, tiling
from tidemark.llm.common import remainder, row_key, unused, without
from tidemark.workspace import pin


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled neighbours call good."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(remainder("doc_id", 3) != 1)
    own = unused("score", docs)
    scored = neighbours.scored(docs.withColumnsRenamed({"score": own}), neighbours.fitted(docs, labels))
    good = scored.where(F.col("score") >= 0.5)
    return good.select(*[F.col(own if c == "score" else c).alias(c) for c in docs.columns])


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard_join.representatives(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = docs.select(row_key("doc_id", "text").alias("row"), "text")
    leaks = pin(tiling.contaminated(rows, benchmark, "row").select("row").distinct(), "leaks")
    return without(docs, leaks, "doc_id", "text").select(*docs.columns)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets replaced; ``n_chars``, where there is one, follows the text."""
    base, spans, text = [unused(c, docs) for c in ("base", "spans", "clean")]
    found = secret_scan.with_spans(docs, base_col=base, spans_col=spans)
    clean = found.withColumn(text, secret_scan.redacted(F.col("text"), F.col(spans)))
    hit = F.size(spans) > 0
    given = {c: F.col(c) for c in docs.columns} | {"text": F.col(text)}
    if "n_chars" in given:
        given["n_chars"] = F.when(hit, F.char_length(text).cast("long")).otherwise(F.col("n_chars"))
    return clean.select(*[column.alias(name) for name, column in given.items()])


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, in place of its text."""
    encoded = byte_bpe.with_tokens(
        docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )
    return encoded.drop("text").withColumn("n_tokens", F.size("token_ids").cast("long"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("byte-level BPE", byte_level_bpe),
]

#: The first stage learns from labels and the last one merges tokens: no SQL for that.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = pin(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
