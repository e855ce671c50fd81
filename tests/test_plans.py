"""What the physical plans must and must not contain."""

import pathlib
import re

import pytest

from tidemark import workspace
from tidemark.operators import daily, ranking
from tidemark.plans import catalog, marts, staging

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark):
    return workspace.pin(catalog.staged(spark, FOLDER), "plans")


def test_no_python_and_no_cross_join(spark):
    for name in ("trending_repos", "label_usage", "cohort_retention", "category_trends",
                 "incremental_batch", "cdc_upsert", "dq_report", "missing_hours"):
        text = plan(catalog.QUERIES[name](spark, FOLDER))
        assert not re.search(r"Python|CartesianProduct|BroadcastNestedLoopJoin", text), name


def test_copies_are_cut_before_the_shuffle(spark):
    text = plan(catalog.staged(spark, FOLDER))
    before, after = text.split("Exchange hashpartitioning(event_id", 1)
    assert "WindowGroupLimit" in before and "WindowGroupLimit" in after


def test_only_used_columns_are_read(stored):
    for df, unused in (
        (daily.repo_daily_stats(stored), ["payload", "actor_login", "event_id"]),
        (marts.category_trends(stored), ["payload", "actor_login", "repo_id", "event_id"]),
        (marts.contributor_retention(stored), ["payload", "repo_id", "repo_name", "actor_login"]),
    ):
        schema = plan(df).split("ReadSchema:")[1].split("\n")[0]
        assert not [c for c in unused if re.search(rf"\b{c}\b", schema)]


def test_filter_reaches_the_scan(stored):
    text = plan(daily.pr_labels(stored))
    assert "EqualTo(event_type,PullRequestEvent)" in text


def test_distinct_counts_spread_a_hot_group(stored):
    text = plan(daily.repo_daily_stats(stored))
    assert re.search(r"Exchange hashpartitioning\(repo_id#\d+L?, date_day#\d+, actor_id#\d+L?", text)


def test_retention_shuffles_three_times_before_the_small_window(stored):
    assert plan(marts.contributor_retention(stored)).count("Exchange hashpartitioning") == 4


def test_ranking_windows_only_the_histogram(stored):
    df = workspace.pin(daily.category_daily(stored), "plan-rank")
    text = plan(ranking.top_ranked(df, "date_day", "event_count", 3, "place"))
    assert "Window" not in text and "BroadcastHashJoin" in text


def test_library_has_no_python_udf_and_no_local_checkpoint():
    root = pathlib.Path(marts.__file__).parent.parent
    code = "\n".join(f.read_text() for f in root.rglob("*.py"))
    for word in ("udf", "localCheckpoint", "crossJoin", "toPandas", ".rdd", "mapInPandas"):
        assert word not in code


def test_newest_instant_reads_one_day(spark):
    path = workspace.fresh_path(spark, "newest")
    staging.full_refresh(catalog.raw(spark, FOLDER), path)
    newest = ranking.newest(staging.read_staged(spark, path), "created_at")
    expected = spark.range(1).select(newest).first()[0]
    from tidemark import tables

    assert tables.newest_instant(spark, path, staging.STAGED_SCHEMA, "created_at") == expected


def test_a_hot_day_is_written_by_several_tasks(spark):
    import os

    from pyspark.sql import functions as F

    from tidemark import tables

    path = workspace.fresh_path(spark, "hot-day")
    rows = spark.range(0, 60_000, 1, 6).select(
        F.sha2(F.col("id").cast("string"), 256).alias("event_id"),
        F.when(F.col("id") % 3 > 0, F.lit("2024-01-01"))
        .otherwise(F.concat(F.lit("2024-01-"), 2 + F.col("id") % 20)).cast("date").alias("date_day"),
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "256KB")
    try:
        tables.write_by_day(rows, path, "event_id")
    finally:
        spark.conf.set(key, old)
    (version,) = set(tables.versions(spark, path).values())
    local = f"{path}/{version}".removeprefix("file:")
    files = {d: len([f for f in os.listdir(f"{local}/{d}") if f.endswith(".parquet")])
             for d in os.listdir(local) if d.startswith("date_day=")}
    assert files["date_day=2024-01-01"] > 4 and min(files.values()) == 1
    assert tables.read_by_day(spark, path, rows.schema).count() == 60_000
