"""One row per key, the earliest one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark import workspace

# Columns that settle which of two copies of the same instant is kept. The
# payload is left out so that a reader which does not need it can prune it.
TIE_BREAK = ("event_type", "actor_id", "actor_login", "repo_id", "repo_name")


def first_seen(
    df: DataFrame,
    key: str = "event_id",
    order: str = "created_at",
    tie_break: tuple[str | Column, ...] = TIE_BREAK,
) -> DataFrame:
    """Earliest row per ``key``.

    ``row_number() = 1`` is planned as a group limit before and after the
    shuffle, so each map task sends one row per key however many copies it has.
    """
    ties = [F.col(c) if isinstance(c, str) else c for c in tie_break]
    window = Window.partitionBy(key).orderBy(
        F.col(order).asc_nulls_last(), *[c.asc_nulls_last() for c in ties]
    )
    return df.withColumn("_copy", F.row_number().over(window)).where("_copy = 1").drop("_copy")


def first_stored(
    df: DataFrame,
    key: str = "event_id",
    order: str = "created_at",
    tie_break: tuple[str, ...] = TIE_BREAK,
) -> DataFrame:
    """As ``first_seen``, for a frame that reads stored Parquet files.

    Whole rows are not shuffled to find copies: a pass over the key column
    names the repeated keys, a second over the order columns the position in
    the files of each one's first row, and the last, over everything, drops the
    other copies by position. Both lists are pinned, so Spark broadcasts them
    up to its size threshold; beyond it the last join shuffles whole rows. Rows
    that agree in all of ``order`` and ``tie_break`` are told apart by file and row
    number.
    """
    rows = df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index").alias("_row"),
    )
    repeated = (
        rows.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_rows")).where("_rows > 1")
    ).select("_key")
    repeated = workspace.pin(repeated, "repeated")
    on_key = F.col(key).eqNullSafe(F.col("_key"))
    place = F.struct(F.col(order).isNull().alias("_timeless"), order, *tie_break, "_file", "_row")
    first = (
        rows.join(repeated, on_key, "left_semi")
        .groupBy(F.col(key).alias("_key"))
        .agg(F.min(place).alias("_first"))
        .select(
            "_key",
            F.col("_first._file").alias("_first_file"),
            F.col("_first._row").alias("_first_row"),
        )
    )
    marked = rows.join(workspace.pin(first, "first-copies"), on_key, "left")
    is_first = (F.col("_file") == F.col("_first_file")) & (F.col("_row") == F.col("_first_row"))
    return marked.where(F.col("_first_file").isNull() | is_first).select(*df.columns)
