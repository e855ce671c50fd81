"""Insert-or-replace by key, on frames and on day-partitioned Parquet tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from tidemark import tables, workspace
from tidemark.functions.expressions import day_of
from tidemark.operators import keyindex


def merged(target: DataFrame, batch: DataFrame, key: str = "event_id") -> DataFrame:
    """``target`` with the rows of ``batch`` replacing or joining it by key.

    ``batch`` holds one row per key. NULL keys never match.
    """
    return target.join(batch.select(key), key, "left_anti").unionByName(batch)


def merge_into(batch: DataFrame, path: str, key: str = "event_id") -> set[date | None]:
    """Upsert ``batch`` (one row per key, stored or pinned) into the table at ``path``.

    Only the days that hold a matched key or receive a row are rewritten. The key
    index names the days that may hold one; their key columns are read, and no
    other day's. The new days are written beside the old ones and published
    together: a run that dies leaves the old table, and running the same batch
    again completes it. Returns the touched days.
    """
    spark = batch.sparkSession
    stored = batch.schema
    keys = batch.select(key)
    batch = batch.withColumn(tables.DAY, day_of(F.col("created_at")))
    keyindex.update(spark, path, stored, key)
    # Collected are days, never keys.
    named = workspace.pin(keyindex.candidates(keys, path, key), "candidates")
    days = {row[0] for row in named.select(tables.DAY).distinct().collect()}
    matched = tables.read_by_day(spark, path, stored, days).select(key, tables.DAY).join(keys, key, "left_semi")
    touched = {row[0] for row in matched.union(batch.select(key, tables.DAY)).select(tables.DAY).distinct().collect()}
    if touched:
        current = tables.read_by_day(spark, path, stored, touched)
        survivors = current.join(keys, key, "left_anti")
        keyindex.add(batch, path, key, tables.versions(spark, path))
        tables.write_by_day(survivors.unionByName(batch), path, key, replace=touched)
        keyindex.note(spark, path)
    return touched
