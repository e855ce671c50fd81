"""Declared checks on day tables, by what was found on each day.

What the checks find on a day is stored; only days with another version than
the one that was checked are read again. A key that is unique within its days may
still be on two of them: the keys of such a day are looked up in the key index,
and the days that it names are asked. What was found so holds for the two versions
that were compared: a pair whose other day has been remade since counts only if
that day's own check has found it again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark import tables, workspace
from tidemark.operators import keyindex, quality

DAY = tables.DAY
#: Reads a model, or some of its days.
Read = Callable[[Iterable[date | None] | None], DataFrame]
SCHEMA = T.StructType(
    [
        T.StructField(c, T.LongType() if c == "failures" else T.DateType() if c == "other_day" else T.StringType())
        for c in quality.FOUND
    ]
    + [T.StructField(DAY, T.DateType())]
)


def live_versions(spark: SparkSession, path: str) -> DataFrame:
    """The days and versions of a table; one row a day."""
    rows = list(tables.versions(spark, path).items())
    return spark.createDataFrame(rows, "live_day date, live_version string")


def on_other_days(spark: SparkSession, model: str, path: str, schema: T.StructType, key: str, days: set[date | None]) -> DataFrame:
    """Keys of ``days`` that another day holds too, with the versions in which both were compared."""
    keyindex.update(spark, path, schema, key)
    own = tables.read_by_day(spark, path, schema, days).select(key, F.col(DAY).alias("own_day"))
    asked = keyindex.candidates(own.select(key), path, key)
    near = own.join(asked.withColumnRenamed(DAY, "other_day"), key)
    near = near.where(~F.col("own_day").eqNullSafe(F.col("other_day"))).distinct()
    near = workspace.pin(near, "near")
    others = {row[0] for row in near.select("other_day").distinct().collect()}
    held = tables.read_by_day(spark, path, schema, others).select(F.col(key).alias("_key"), F.col(DAY).alias("_day"))
    both = near.join(held, (F.col(key) == F.col("_key")) & F.col("other_day").eqNullSafe(F.col("_day")), "left_semi")
    version = lambda day, name: live_versions(spark, path).select(
        F.col("live_day").alias(f"_{name}"), F.col("live_version").alias(name)
    )
    for day, name in (("own_day", "own_version"), ("other_day", "other_version")):
        both = both.join(version(day, name), F.col(day).eqNullSafe(F.col(f"_{name}")))
    return both.select(
        F.lit("unique").alias("check"),
        F.lit(model).alias("model"),
        F.lit(key).alias("column"),
        F.lit(1).cast("bigint").alias("failures"),
        F.col(key).cast("string").alias("value"),
        "other_day",
        "own_version",
        "other_version",
        F.col("own_day").alias(DAY),
    )


def update(
    spark: SparkSession,
    state: str,
    staged: str,
    staged_schema: T.StructType,
    models: Mapping[str, Read],
    key: str = "event_id",
) -> set[date | None]:
    """Check the days of ``staged`` that are new since; returns them.

    ``models`` are made from the staged days. ``key`` is unique over all days of the
    staged table, the first of the models; the others' keys name their day.
    """
    now, seen = tables.versions(spark, staged), tables.versions(spark, f"{state}_seen")
    days = {day for day in now.keys() | seen.keys() if now.get(day) != seen.get(day)}
    if not days and tables.published(spark, f"{state}_seen"):
        return days
    first = next(iter(models))
    found = on_other_days(spark, first, staged, staged_schema, key, days)
    for model, read in models.items():
        found = found.unionByName(quality.found_by_day(model, read(days), quality.CHECKS[model], DAY))
    tables.write_by_day(found, state, "check", replace=days)
    tables.remove_old(spark, state)
    tables.publish(spark, f"{state}_seen", now)
    return days


def report(spark: SparkSession, state: str, staged: str, models: Iterable[str]) -> DataFrame:
    """The report of all days."""
    found = tables.read_by_day(spark, state, SCHEMA)
    live = live_versions(spark, staged)
    still = F.col("other_day").eqNullSafe(F.col("live_day")) & (F.col("other_version") == F.col("live_version"))
    alone = found.where(F.col("other_version").isNull())
    paired = found.where(F.col("other_version").isNotNull()).join(live, still, "left_semi")
    return quality.put_together(alone.unionByName(paired), {model: quality.CHECKS[model] for model in models})
