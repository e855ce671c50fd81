"""The raw table as an append-only stream into the staged table."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import tables, workspace
from tidemark.functions.expressions import instant
from tidemark.operators.upsert import merge_into
from tidemark.plans.staging import STAGED_SCHEMA, stage_to_store, write_staged
from tidemark.sources.landing import LOADED, RAW_SCHEMA, STORED_SCHEMA


def raw_changes(spark: SparkSession, raw_path: str, files_per_batch: int | None = None) -> DataFrame:
    """Rows appended to the raw table, in the raw columns, with the hash of the line."""
    reader = spark.readStream.schema(STORED_SCHEMA)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stored = reader.parquet(raw_path)
    return stored.where(F.col("load_status") == LOADED).select(*RAW_SCHEMA.names, "line_hash")


def apply_changes(
    changes: DataFrame,
    path: str,
    require_repo: bool = True,
    lookback_hours: int | None = None,
) -> None:
    """Upsert one batch of raw rows. Running it again changes nothing.

    The last batch wins, as there is no lookback; with ``lookback_hours``,
    events at or before the stored maximum less that are left out.
    """
    spark = changes.sparkSession
    if lookback_hours is not None:
        newest = tables.newest_instant(spark, path, STAGED_SCHEMA, "created_at")
        if newest is not None:
            bound = newest - timedelta(hours=lookback_hours)
            changes = changes.where(F.col("created_at") > instant(bound))
    staged = stage_to_store(changes, require_repo)
    if not tables.published(spark, path):
        write_staged(staged, path)
        return
    with workspace.scoped(spark):
        merge_into(workspace.pin(staged, "changes"), path)


def follow_raw(
    spark: SparkSession,
    raw_path: str,
    path: str,
    checkpoint: str,
    require_repo: bool = True,
    lookback_hours: int | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Apply what was appended since the last call, then stop.

    No batch runs when nothing is new. Call it hourly; the checkpoint folder
    remembers the position.
    """
    return (
        raw_changes(spark, raw_path, files_per_batch)
        .writeStream.foreachBatch(
            lambda batch, _: apply_changes(batch, path, require_repo, lookback_hours)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def drop_repeats(
    events: DataFrame,
    hours: int = 3,
    key: str = "event_id",
    at: str = "created_at",
    salts: int = 16,
) -> DataFrame:
    """Streaming form of the dedup, with state kept for ``hours`` only.

    Copies are dropped within (key, salt) first, so that an event with very many
    copies is spread over tasks and at most ``salts`` of them reach the second
    step. The late filter follows the watermark, which lags one batch behind
    the stored maximum; use ``lookback_hours`` above where the bound must be
    exact.
    """
    return (
        events.withColumn("_at", F.col(at).cast("timestamp"))
        .withColumn("_salt", (F.rand(0) * salts).cast("int"))
        .withWatermark("_at", f"{int(hours)} hours")
        .dropDuplicatesWithinWatermark([key, "_salt"])
        .dropDuplicatesWithinWatermark([key])
        .drop("_at", "_salt")
    )
