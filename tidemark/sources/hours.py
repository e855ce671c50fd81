"""Expected hours of a backfill, and those that are missing."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.expressions import hour_key, hour_path


def previous_hour(now: datetime | None = None) -> datetime:
    """The last complete UTC hour, which a run without a range loads."""
    now = now or datetime.now(timezone.utc)
    return now.replace(minute=0, second=0, microsecond=0, tzinfo=None) - timedelta(hours=1)


def spine(bounds: DataFrame, start: str | Column = "start", end: str | Column = "end") -> DataFrame:
    """Every hour of the days from ``start`` to ``end``, both included.

    ``bounds`` is one row of dates, so the result is bounded by the calendar.
    """
    first = F.to_date(start).cast("timestamp_ntz")
    last = F.to_date(end).cast("timestamp_ntz") + F.expr("INTERVAL 23 HOURS")
    return bounds.select(
        F.explode(F.sequence(first, last, F.expr("INTERVAL 1 HOUR"))).alias("hour")
    ).select(
        "hour", hour_key(F.col("hour")).alias("hour_key"), hour_path(F.col("hour")).alias("path")
    )


def hour_spine(spark: SparkSession, start: date, end: date) -> DataFrame:
    return spine(spark.createDataFrame([(start, end)], "start date, end date"))


def missing_hours(expected: DataFrame, loaded: DataFrame) -> DataFrame:
    """Hours of the spine that ``loaded`` (a column ``hour``) does not hold."""
    return expected.join(loaded.select("hour").distinct(), "hour", "left_anti")
