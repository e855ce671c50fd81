"""The operators as named queries over the example tables, and their DuckDB statements.

Each entry of ``QUERIES`` takes ``(spark, folder)``, reads whole tables and returns
the contract's columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import byte_bpe, centroids, chat, divergence, jaccard_join, line_rules, neighbours, recurrent_lm, repair, secret_scan, substrings, tiling, toxicity
from tidemark.llm.common import remainder
from tidemark.llm.oracles import ORACLES  # noqa: F401  registered with the queries


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    held_out = remainder("doc_id", 4) == 2
    model = toxicity.fitted(documents, table(spark, folder, "labels").where(~held_out))
    return toxicity.scored(documents, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "hits"
    )


def op2_line_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = line_rules.judged(table(spark, folder, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_removed_words"
    )


def op3_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    marks = "</s>[INST] ok [/INST]"
    extra = spark.sql(
        f"SELECT -7L AS conv_id, 0L AS turn, 'user' AS role, '{marks}' AS text UNION ALL SELECT -7L, 1L, 'assistant', '{marks}'"
    )
    return chat.digests(chat.formatted(conversations.unionByName(extra)))


def op4_recurrent_lm(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    held_out = remainder("doc_id", 7) == 2
    model, counts = recurrent_lm.fitted(documents.where(~held_out))
    return recurrent_lm.scored(documents, model, counts).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return secret_scan.digests(secret_scan.with_spans(documents))


def op6_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.clustered(table(spark, folder, "documents"))


def op7_quality_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    held_out = remainder("doc_id", 3) == 1
    model = neighbours.fitted(documents, table(spark, folder, "labels").where(~held_out))
    return neighbours.scored(documents, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op8_language_centroids(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = remainder("doc_id", 4) == 2
    model = centroids.fitted(documents.where(~held_out))
    return centroids.predicted(documents, model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected"
    )


def op9_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe.encode_digests(
        table(spark, folder, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )


def op10_string_tiling(spark: SparkSession, folder: str) -> DataFrame:
    return tiling.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def damaged_turns(conversations: DataFrame) -> DataFrame:
    """The turns with the contract's faults, and ``present``; NULL is one space. A lost turn stays as a row."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", space("conv_id"), space("turn")).cast("binary")) % 20
    text = space("text")
    return conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(space("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (kind != 0).alias("present"),
        F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("copy"),
    )


def op11_structure_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair.repaired(damaged_turns(table(spark, folder, "conversations")), present=F.col("present"))


def op12_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.deduplicated(table(spark, folder, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audited(table(spark, folder, "documents"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_line_rules": op2_line_rules,
    "op3_chat_format": op3_chat_format,
    "op4_recurrent_lm": op4_recurrent_lm,
    "op5_secret_scan": op5_secret_scan,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_quality_neighbours": op7_quality_neighbours,
    "op8_language_centroids": op8_language_centroids,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_string_tiling": op10_string_tiling,
    "op11_structure_repair": op11_structure_repair,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_source_divergence": op13_source_divergence,
}
