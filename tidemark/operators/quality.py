"""Data-quality checks: each gives a frame of (check, model, column, failures, ...)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.expressions import EVENT_CATEGORIES, instant

ERROR, WARN = "error", "warn"


@dataclass(frozen=True)
class Check:
    kind: str  # not_null, unique or accepted_values
    column: str
    severity: str = ERROR
    values: Sequence[str] = ()


# The checks declared per model.
CHECKS: Mapping[str, tuple[Check, ...]] = {
    "raw_events": (
        Check("unique", "id"),
        Check("not_null", "id"),
        Check("not_null", "type"),
        Check("not_null", "created_at"),
    ),
    "staged_events": (
        Check("unique", "event_id"),
        Check("not_null", "event_id"),
        Check("not_null", "event_type"),
        Check("accepted_values", "event_type", WARN, tuple(EVENT_CATEGORIES)),
    ),
    "repo_daily_stats": (
        Check("unique", "surrogate_key"),
        Check("not_null", "surrogate_key"),
        Check("not_null", "repo_id", WARN),
    ),
    "developer_activity": (
        Check("unique", "surrogate_key"),
        Check("not_null", "surrogate_key"),
        Check("not_null", "actor_id"),
    ),
    "pr_labels": (Check("not_null", "event_id"), Check("not_null", "label_name")),
    "trending_repos": (
        Check("not_null", "repo_id"),
        Check("not_null", "repo_name"),
        Check("not_null", "date_day"),
    ),
    "contributor_retention": (Check("not_null", "cohort_month"),),
    "category_trends": (Check("not_null", "date_day"), Check("not_null", "event_category")),
    "label_usage": (Check("not_null", "date_day"), Check("not_null", "label_name")),
}


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column, all columns in one pass: (column, failures)."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column", "failures")


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values held by more than one row, NULL apart: (column, failures)."""
    repeated = (
        df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_rows"))
    ).where("_rows > 1")
    return repeated.agg(F.lit(column).alias("column"), F.count("*").alias("failures"))


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Different values outside the list, NULL apart: (column, failures)."""
    strange = df.where(~F.col(column).isin(list(values))).select(column).distinct()
    return strange.agg(F.lit(column).alias("column"), F.count("*").alias("failures"))


def status_of(failures: Column, severity: Column) -> Column:
    return F.when(failures == 0, "pass").when(severity == WARN, "warn").otherwise("fail")


def _result(check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(check.kind).alias("check"),
        F.lit(check.column).alias("column"),
        F.coalesce(failures, F.lit(0)).cast("bigint").alias("failures"),
        F.lit(check.severity).alias("severity"),
    )


def run_checks(model: str, df: DataFrame, checks: Iterable[Check]) -> DataFrame:
    """One row per declared check of a model.

    The NULL counts share a pass over the model, and ride along with the
    grouping of the first unique check if there is one.
    """
    checks = list(checks)
    nulls = [c for c in checks if c.kind == "not_null"]
    uniques = [c for c in checks if c.kind == "unique"]
    counts = [F.count_if(F.col(c.column).isNull()).alias(f"_{i}") for i, c in enumerate(nulls)]
    results = []
    if uniques:
        key = F.col(uniques[0].column)
        keyed = df.groupBy(key.alias("_key")).agg(F.count("*").alias("_rows"), *counts)
        repeated = F.count_if(F.col("_key").isNotNull() & (F.col("_rows") > 1))
        sums = [F.sum(f"_{i}") for i in range(len(nulls))]
        rows = [_result(uniques[0], repeated)] + [_result(c, s) for c, s in zip(nulls, sums)]
        results.append(keyed.agg(F.array(*rows).alias("_results")))
    elif nulls:
        rows = [_result(c, n) for c, n in zip(nulls, counts)]
        results.append(df.agg(F.array(*rows).alias("_results")))
    for check in uniques[1:]:
        row = _result(check, F.col("failures"))
        results.append(unique(df, check.column).select(F.array(row).alias("_results")))
    for check in (c for c in checks if c.kind == "accepted_values"):
        counted = accepted_values(df, check.column, check.values)
        results.append(
            counted.select(F.array(_result(check, F.col("failures"))).alias("_results"))
        )
    report = reduce(DataFrame.unionByName, results).select(F.inline("_results"))
    return report.select(
        "check",
        F.lit(model).alias("model"),
        "column",
        "failures",
        "severity",
        status_of(F.col("failures"), F.col("severity")).alias("status"),
    )


#: What the checks of a model found on one day: a count of NULLs, or one row per
#: strange value, or per key that is there twice. ``other_day`` also holds the key.
FOUND = ("check", "model", "column", "failures", "value", "other_day", "own_version", "other_version")


def found_by_day(model: str, df: DataFrame, checks: Iterable[Check], day: str) -> DataFrame:
    """``FOUND`` and the day, each day by itself. Values stay apart, so that days can be put together."""
    parts = []
    shown = lambda check, failures, value: [
        F.lit(check.kind).alias("check"), F.lit(model).alias("model"), F.lit(check.column).alias("column"),
        failures.cast("bigint").alias("failures"), value.cast("string").alias("value"),
        F.lit(None).cast("date").alias("other_day"),
        *[F.lit(None).cast("string").alias(c) for c in FOUND[-2:]], day,
    ]
    checks = list(checks)
    nulls = [c for c in checks if c.kind == "not_null"]
    if nulls:
        counted = df.groupBy(day).agg(
            *[F.count_if(F.col(c.column).isNull()).alias(f"_{i}") for i, c in enumerate(nulls)]
        )
        rows = F.array(*[
            F.struct(F.lit(c.column).alias("column"), F.col(f"_{i}").alias("failures")) for i, c in enumerate(nulls)
        ])
        each = counted.select(day, F.inline(rows)).where("failures > 0")
        fields = shown(nulls[0], F.col("failures"), F.lit(None))
        parts.append(each.select(*fields[:2], "column", *fields[3:]))
    for check in (c for c in checks if c.kind != "not_null"):
        value = F.col(check.column)
        if check.kind == "unique":
            rows = df.where(value.isNotNull()).groupBy(day, value.alias("_key")).agg(F.count("*").alias("_rows"))
            rows = rows.where("_rows > 1")
        else:
            rows = df.where(~value.isin(list(check.values))).select(day, value.alias("_key")).distinct()
        parts.append(rows.select(*shown(check, F.lit(1), F.col("_key"))))
    return reduce(DataFrame.unionByName, parts)


def put_together(found: DataFrame, checks: Mapping[str, Sequence[Check]]) -> DataFrame:
    """The report of whole models from what was found on their days.

    NULLs are added up; of values and keys the different ones are counted.
    """
    spark = found.sparkSession
    counted = found.groupBy("check", "model", "column").agg(
        F.sum("failures").alias("_sum"), F.count_distinct("value").alias("_values")
    )
    declared = [(c.kind, model, c.column, c.severity) for model, own in checks.items() for c in own]
    rows = spark.createDataFrame(declared, "check string, model string, column string, severity string")
    failures = F.when(F.col("check") == "not_null", F.col("_sum")).otherwise(F.col("_values"))
    report = rows.join(counted, ["check", "model", "column"], "left")
    return report.select(
        "check",
        "model",
        "column",
        F.coalesce(failures, F.lit(0)).cast("bigint").alias("failures"),
        "severity",
    ).withColumn("status", status_of(F.col("failures"), F.col("severity")))


def quality_report(
    models: Mapping[str, DataFrame], checks: Mapping[str, Sequence[Check]] = CHECKS
) -> DataFrame:
    """All declared checks of the given models."""
    reports = [run_checks(model, df, checks[model]) for model, df in models.items()]
    return reduce(DataFrame.unionByName, reports)


def failed(report: DataFrame) -> DataFrame:
    """The checks that must stop a job; warnings do not."""
    return report.where(F.col("status") == "fail")


def freshness(
    df: DataFrame,
    as_of: datetime | Column,
    at: str = "created_at",
    warn_hours: int = 2,
    error_hours: int = 6,
) -> DataFrame:
    """Age of the newest row against two limits, to the microsecond; an empty table
    is an error. ``age_seconds`` is for showing only."""
    now = as_of if isinstance(as_of, Column) else instant(as_of)
    latest = df.agg(F.max(at).alias("max_loaded_at")).withColumn(
        "as_of", now.cast("timestamp_ntz")
    )
    seconds = F.timestamp_diff("SECOND", F.col("max_loaded_at"), F.col("as_of"))
    older = lambda hours: F.col("max_loaded_at") < F.col("as_of") - F.expr(
        f"INTERVAL {int(hours)} HOURS"
    )
    return latest.withColumn("age_seconds", seconds.cast("bigint")).withColumn(
        "status",
        F.when(F.col("max_loaded_at").isNull() | older(error_hours), "error")
        .when(older(warn_hours), "warn")
        .otherwise("pass"),
    )


def freshness_check(model: str, found: DataFrame, column: str = "created_at") -> DataFrame:
    """A row of :func:`freshness` as a row of the report."""
    late = F.col("status") != "pass"
    return found.select(
        F.lit("freshness").alias("check"),
        F.lit(model).alias("model"),
        F.lit(column).alias("column"),
        late.cast("bigint").alias("failures"),
        F.when(F.col("status") == "warn", WARN).otherwise(ERROR).alias("severity"),
        F.when(F.col("status") == "error", "fail").otherwise(F.col("status")).alias("status"),
    )
