"""Windows over day-grain tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark import workspace
from tidemark.functions.expressions import month_of, safe_divide


def rolling_sums(
    daily: DataFrame,
    sums: Mapping[str, str],
    key: str = "repo_id",
    day: str = "date_day",
    length: int = 7,
    calendar: bool = False,
) -> DataFrame:
    """Add ``{output: column}`` sums over the last ``length`` days of each key.

    By default the frame counts rows, that is days on which the key was active;
    ``calendar=True`` counts calendar days. A key has at most one row per day,
    so a partition is bounded by the calendar however hot the key is.
    """
    by_key = Window.partitionBy(key)
    if calendar:
        frame = by_key.orderBy(F.unix_date(F.col(day))).rangeBetween(1 - length, 0)
    else:
        frame = by_key.orderBy(F.col(day).asc_nulls_last()).rowsBetween(1 - length, 0)
    return daily.withColumns({out: F.sum(column).over(frame) for out, column in sums.items()})


def reached_rows(
    rows: DataFrame, changed: DataFrame, key: str = "repo_id", day: str = "date_day", length: int = 7
) -> DataFrame:
    """The (key, day) of ``rows`` whose frame of ``length`` rows holds a changed (key, day), or held it.

    ``changed`` also names pairs that are gone from ``rows``: a row that was among
    the ``length - 1`` next behind such a day has another frame now. ``rows`` must
    hold all days of the changed keys.
    """
    pair = lambda df, there, marked: df.select(
        key, day, F.lit(there).alias("_there"), F.lit(marked).alias("_marked")
    )
    both = pair(rows, 1, False).unionByName(pair(changed, 0, True)).groupBy(key, day)
    both = both.agg(F.max("_there").alias("_there"), F.max("_marked").alias("_marked"))
    so_far = Window.partitionBy(key).orderBy(F.col(day).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    placed = both.withColumn("_place", F.sum("_there").over(so_far))
    mark = F.last(F.when(F.col("_marked"), F.col("_place")), ignorenulls=True).over(so_far)
    near = (F.col("_there") == 1) & (F.col("_place") - mark < length)
    return placed.withColumn("_near", near).where("_near").select(key, day)


def top_ranked(df: DataFrame, group: str, value: str, limit: int, rank: str) -> DataFrame:
    """Rows whose ``rank()`` by descending ``value`` within ``group`` is ``<= limit``.

    All ties are kept. The rank is read off a histogram: one plus the number of
    rows at higher values. Only the histogram is windowed (per group it holds
    the different values, not the rows), and at most ``limit`` values per group
    survive. They are pinned, so that Spark knows their size when it chooses
    how to join them back: by broadcast up to its threshold, which leaves the
    rows where they are, else by a sort-merge join, whose hot keys adaptive
    execution splits. A group, or a tie, that holds most of the table is thus
    never sorted by one task. ``df`` is read twice: pass a stored or pinned
    frame.
    """
    levels = df.groupBy(group, value).agg(F.count("*").alias("_rows"))
    higher = (
        Window.partitionBy(group)
        .orderBy(F.col(value).desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    place = F.coalesce(F.sum("_rows").over(higher), F.lit(0)) + F.lit(1).cast("bigint")
    kept = levels.select(
        F.col(group).alias("_group"), F.col(value).alias("_value"), place.alias(rank)
    ).where(F.col(rank) <= limit)
    same = F.col(group).eqNullSafe(F.col("_group")) & F.col(value).eqNullSafe(F.col("_value"))
    return df.join(workspace.pin(kept, "ranks"), same).drop("_group", "_value")


def change_over_rows(
    daily: DataFrame, value: str, key: str, day: str, rows: int, before: str, rate: str
) -> DataFrame:
    """Add the value ``rows`` rows earlier in the same key, and the growth since."""
    earlier = F.lag(value, rows).over(
        Window.partitionBy(key).orderBy(F.col(day).asc_nulls_last())
    )
    return daily.withColumn(before, earlier).withColumn(
        rate, safe_divide(F.col(value) - F.col(before), F.col(before))
    )


def first_seen_month(activity: DataFrame, actor: str = "actor_id", day: str = "date_day") -> DataFrame:
    """Add ``cohort_month``: the month of each actor's first day."""
    first_day = F.min(day).over(Window.partitionBy(actor))
    return activity.withColumn("cohort_month", month_of(first_day))


def at_latest(df: DataFrame, column: str = "date_day") -> DataFrame:
    """Rows of the greatest ``column`` value."""
    return df.where(F.col(column) == newest(df, column))


def trailing_days(df: DataFrame, days: int, column: str = "date_day") -> DataFrame:
    """Rows from ``days`` days before the latest day on: ``days + 1`` days in all."""
    return df.where(F.col(column) >= F.date_sub(newest(df, column), days))


def newest(df: DataFrame, column: str) -> Column:
    """The maximum of a column as a scalar subquery."""
    return df.select(F.max(column)).scalar()
