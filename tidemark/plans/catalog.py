"""Every operator as a named query over the example tables.

Each entry takes ``(spark, folder)`` and returns a frame. All read whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark import tables, workspace
from tidemark.functions.expressions import event_category, hour_path
from tidemark.operators import daily, quality, ranking
from tidemark.operators.dedup import first_seen
from tidemark.operators.upsert import merge_into, merged
from tidemark.plans import build, checks, increments, marts, serving, staging
from tidemark.sources import hours, landing, shapes
from tidemark.streaming import changes

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def raw(spark: SparkSession, folder: str) -> DataFrame:
    return shapes.raw_from_events(table(spark, folder, "events"))


def staged(spark: SparkSession, folder: str) -> DataFrame:
    return staging.stage_events(raw(spark, folder))


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return shapes.activity_from_orders(table(spark, folder, "orders"))


def lineitem(spark: SparkSession, folder: str) -> DataFrame:
    return shapes.activity_from_lineitem(table(spark, folder, "lineitem"))


def shown(read: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: serving.in_order(df, read)


def on(source: Query, *steps: Callable[[DataFrame], DataFrame]) -> Query:
    """A query that applies ``steps`` to what ``source`` reads."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        df = source(spark, folder)
        for step in steps:
            df = step(df)
        return df

    return query


def mart(label: str) -> Callable[[DataFrame], DataFrame]:
    """Store a mart before it is read by value and by its latest day."""
    return lambda df: workspace.pin(df, label)


# --- landing -----------------------------------------------------------------


def land(spark: SparkSession, folder: str) -> str:
    """Land ``events`` as gzipped JSON lines; returns the landing root."""
    root = workspace.fresh_path(spark, "landing")
    shapes.write_landing(shapes.lines_from_events(table(spark, folder, "events")), root)
    return root


def raw_json_scan(spark: SparkSession, folder: str) -> DataFrame:
    root = land(spark, folder)
    lines = landing.scan_lines(spark, root, root)
    return staging.typed(lines.where(F.col("load_status") == landing.LOADED)).select(
        "event_id",
        "event_type",
        "actor_id",
        "actor_login",
        "repo_id",
        "repo_name",
        F.try_variant_get("payload", "$.action", "string").alias("action"),
        F.try_variant_get("payload", "$.pull_request.number", "bigint").alias("pr_number"),
        "created_at",
    )


def load_report(spark: SparkSession, folder: str) -> DataFrame:
    """The hours before the last day are loaded, then all: the first are in the ledger already."""
    last = table(spark, folder, "events").agg(F.date_trunc("day", F.max("ts"))).first()[0]
    root = land(spark, folder)
    path, ledger = workspace.fresh_path(spark, "raw"), workspace.fresh_path(spark, "ledger")
    landing.load_hours(spark, root, path, ledger, end=last - timedelta(hours=1))
    report = landing.load_hours(spark, root, path, ledger)
    hour = F.regexp_extract("source_file", r"^(.*)/[^/]*$", 1)
    return report.groupBy(hour.alias("source_hour"), "status").agg(
        F.sum("rows_loaded").alias("rows_loaded"), F.sum("errors_seen").alias("errors_seen")
    )


def backfill_result(spark: SparkSession, folder: str) -> DataFrame:
    """The last two days are loaded and staged, then all days before them are
    backfilled, whose files hold events of the hour before too."""
    last = table(spark, folder, "events").agg(F.date_trunc("day", F.max("ts"))).first()[0]
    root = workspace.fresh_path(spark, "landing")
    shapes.write_landing(shapes.late_lines(table(spark, folder, "events")), root)
    layout = build.Layout(workspace.fresh_path(spark, "tables"))
    load = lambda **bounds: landing.load_hours(spark, root, layout.raw, layout.ledger, **bounds)
    load(start=last - timedelta(days=1))
    build.stage(spark, layout)
    first = table(spark, folder, "events").agg(F.date_trunc("day", F.min("ts"))).first()[0]
    end = last - timedelta(days=1, hours=1)
    load(start=first, end=end)
    build.stage_hours(spark, layout, first, end)
    return staging.read_staged(spark, layout.staged).select(*SCALARS)


def unloaded_files(spark: SparkSession, folder: str) -> DataFrame:
    """Hours with events are landed; those before the last day are in the ledger."""
    events = table(spark, folder, "events").select(F.date_trunc("hour", "ts").alias("hour"))
    last_day = F.to_date(ranking.newest(events, "hour"))
    paths = lambda rows: rows.distinct().select(
        hour_path(F.col("hour")).alias("source_file")
    )
    return landing.unloaded(paths(events), paths(events.where(F.to_date("hour") < last_day)))


def hour_spine(spark: SparkSession, folder: str) -> DataFrame:
    bounds = table(spark, folder, "events").agg(
        F.min("ts").alias("start"), F.max("ts").alias("end")
    )
    return hours.spine(bounds)


def missing_hours(spark: SparkSession, folder: str) -> DataFrame:
    """Orders arrive at midnight only, so the other hours of each day are missing."""
    placed = table(spark, folder, "orders").select(
        F.date_trunc("hour", "o_orderdate").cast("timestamp_ntz").alias("hour")
    )
    bounds = placed.agg(F.min("hour").alias("start"), F.max("hour").alias("end"))
    return hours.missing_hours(hours.spine(bounds), placed)


# --- staging -----------------------------------------------------------------


def stage_events(spark: SparkSession, folder: str) -> DataFrame:
    return staged(spark, folder).withColumn("payload", F.to_json("payload"))


def full_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """The staged table rebuilt from a stored raw table."""
    path = workspace.fresh_path(spark, "staged")
    staging.full_refresh(workspace.pin(raw(spark, folder), "raw"), path, stored=True)
    return staging.read_staged(spark, path).select(*SCALARS, tables.DAY)


def dedup_events(spark: SparkSession, folder: str) -> DataFrame:
    kept = first_seen(raw(spark, folder), key="id", tie_break=("type",))
    return kept.select("id", "type", "created_at")


SCALARS = [
    "event_id",
    "event_type",
    "actor_id",
    "actor_login",
    "repo_id",
    "repo_name",
    "created_at",
]


def split_at_last_days(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Raw events before the last five days, as first staged, and all of them."""
    everything = raw(spark, folder)
    cut = F.date_sub(ranking.newest(everything, "created_at"), 5)
    return staging.stage_events(everything.where(F.col("created_at") < cut)), everything


def stored_target(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The same, with the staged rows stored: they are read for their maximum too."""
    target, everything = split_at_last_days(spark, folder)
    return workspace.pin(target, "target"), everything


def incremental_batch(spark: SparkSession, folder: str) -> DataFrame:
    target, everything = stored_target(spark, folder)
    return staging.incremental_batch(everything, target).select(*SCALARS)


def upsert_result(spark: SparkSession, folder: str) -> DataFrame:
    """An incremental run on a stored table: lookback, dedup, upsert by day."""
    target, everything = split_at_last_days(spark, folder)
    path = workspace.fresh_path(spark, "staged")
    staging.write_staged(target, path)
    staging.incremental_run(everything, path)
    return staging.read_staged(spark, path).select(*SCALARS, tables.DAY)


def upsert_random_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The same upsert where ids have no order in time, so that the key index alone can tell their days."""
    everything = raw(spark, folder).withColumn("id", F.md5(F.col("id").cast("binary")))
    cut = F.date_sub(ranking.newest(everything, "created_at"), 5)
    path = workspace.fresh_path(spark, "staged")
    staging.write_staged(staging.stage_events(everything.where(F.col("created_at") < cut)), path)
    staging.incremental_run(everything, path)
    return staging.read_staged(spark, path).select(*SCALARS, tables.DAY)


def cdc_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """The change stream's upsert: no lookback, and no events without a repo.
    What came before noon is staged; what came later is the batch, in which
    repeats of staged events replace them."""
    everything = raw(spark, folder)
    morning = F.hour("created_at") < 12
    target = staging.stage_events(everything.where(morning))
    batch = staging.stage_events(everything.where(~morning), require_repo=True)
    return merged(target, batch).select(*SCALARS)


def stream_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """The same as a stream: the raw table grows by a morning part and an
    afternoon part, and after each one the stream is followed."""
    everything = landing.as_stored(raw(spark, folder))
    store, path, position = [
        workspace.fresh_path(spark, label) for label in ("raw", "staged", "position")
    ]
    morning = F.hour("created_at") < 12
    for part in (morning, ~morning):
        everything.where(part).write.mode("append").partitionBy("load_status").parquet(store)
        changes.follow_raw(spark, store, path, position).awaitTermination()
    return staging.read_staged(spark, path).select(*SCALARS)


def late_rejects(spark: SparkSession, folder: str) -> DataFrame:
    target, everything = stored_target(spark, folder)
    return staging.too_late(everything, target).select("id", "type", "created_at")


def event_category_counts(spark: SparkSession, folder: str) -> DataFrame:
    return (
        staged(spark, folder)
        .groupBy(event_category(F.col("event_type")).alias("event_category"))
        .agg(F.count("*").alias("event_count"))
    )


# --- checks ------------------------------------------------------------------


def checked_models(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All models that have declared checks, built on one stored staged table."""
    events = workspace.pin(staging.stage_to_store(raw(spark, folder)), "staged")
    return {
        "raw_events": raw(spark, folder),
        "staged_events": events,
        "repo_daily_stats": daily.repo_daily_stats(events),
        "developer_activity": daily.developer_activity(events),
        "pr_labels": daily.pr_labels(events),
        "trending_repos": marts.trending_repos(events),
        "contributor_retention": marts.contributor_retention(events),
        "category_trends": marts.category_trends(events),
        "label_usage": marts.label_usage(events),
    }


def dq_by_day(spark: SparkSession, folder: str) -> DataFrame:
    """Checks put together from what was found on each day.

    The table holds every delivery, so that repeats lie within days and across
    midnight. It is checked without its last five days and with one day empty, and
    again when these have come.
    """
    events = workspace.pin(staging.typed(raw(spark, folder)), "deliveries").withColumn(tables.DAY, F.to_date("created_at"))
    newest = events.select(F.max(tables.DAY)).scalar()
    late = (F.col(tables.DAY) > F.date_sub(newest, 5)) | (F.col(tables.DAY) == F.date_sub(newest, 12))
    root = workspace.fresh_path(spark, "tables")
    path, state = f"{root}/deliveries", f"{root}/checked"
    read = lambda only: staging.read_staged(spark, path, only)
    models = {"staged_events": read, "pr_labels": lambda only: daily.with_day(daily.pr_labels(read(only)))}
    for days in (~late, late):
        replaced = {row[0] for row in events.where(days).select(tables.DAY).distinct().collect()}
        tables.write_by_day(events.where(days), path, "event_id", replace=replaced)
        checks.update(spark, state, path, staging.STAGED_SCHEMA, models)
    return checks.report(spark, state, path, models)


def dq_report(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_report(checked_models(spark, folder))


def dq_not_null(spark: SparkSession, folder: str) -> DataFrame:
    return quality.not_null(staged(spark, folder).drop("payload"), SCALARS)


def dq_unique(spark: SparkSession, folder: str) -> DataFrame:
    return quality.unique(raw(spark, folder), "id")


def dq_accepted_values(spark: SparkSession, folder: str) -> DataFrame:
    """The example tables' own kinds, none of which is an accepted type."""
    events = table(spark, folder, "events")
    return quality.accepted_values(events, "event_type", list(shapes.EVENT_KINDS.values()))


def dq_freshness(spark: SparkSession, folder: str) -> DataFrame:
    """As of times that lie on a limit, just beyond it, and in between."""
    events = raw(spark, folder)
    newest = ranking.newest(events, "created_at")
    rows = None
    for hours in (0, 2, 4, 6):
        for late in (0, 500_000):
            as_of = newest + F.expr(f"INTERVAL {hours} HOURS") + F.expr(f"INTERVAL {late} MICROSECONDS")
            row = quality.freshness(events, as_of)
            rows = row if rows is None else rows.unionByName(row)
    return rows


# --- serving -----------------------------------------------------------------


def insight_feed(spark: SparkSession, folder: str) -> DataFrame:
    events = workspace.pin(staged(spark, folder), "staged")
    return serving.insight_feed(
        workspace.pin(marts.trending_repos(events), "trending"),
        workspace.pin(marts.category_trends(events), "trends"),
        workspace.pin(marts.label_usage(events), "labels"),
    )


def log_insights(spark: SparkSession, folder: str) -> str:
    """Two briefings logged for the newest events."""
    trending = workspace.pin(marts.trending_repos(staged(spark, folder)), "trending")
    now = table(spark, folder, "events").agg(F.max("ts")).first()[0]
    path = workspace.fresh_path(spark, "insights")
    for minutes, text in ((0, "first briefing"), (5, "second briefing")):
        serving.append_insight(
            trending, path, text, "none", now.replace(minute=minutes, second=0, microsecond=0)
        )
    return path


def latest_insight(spark: SparkSession, folder: str) -> DataFrame:
    """The later briefing, with the best entry of its list."""
    path = log_insights(spark, folder)
    best = (
        serving.insight_log(spark, path)
        .groupBy("generated_at")
        .agg(F.min(F.struct("place", "item")).alias("best"), F.count("*").alias("entries"))
    )
    return serving.latest_insight(spark, path).join(best, "generated_at").select(
        "insight_text", "generated_at", "model_used", F.col("best.item").alias("best"), "entries"
    )


def insight_log(spark: SparkSession, folder: str) -> DataFrame:
    return serving.in_order(serving.insight_log(spark, log_insights(spark, folder)), "insight_log")


def trending_for_day(spark: SparkSession, folder: str) -> DataFrame:
    """A day picked by a reader: here a week before the last."""
    trending = workspace.pin(marts.trending_repos(staged(spark, folder)), "trending")
    day = F.date_sub(ranking.newest(trending, "date_day"), 7)
    return serving.in_order(serving.trending_for_day(trending, day), "trending_for_day")


# --- the job -----------------------------------------------------------------


def incremented(spark: SparkSession, folder: str) -> build.Layout:
    """Day tables and marts after a first run and an increment of the last five days."""
    layout = build.Layout(workspace.fresh_path(spark, "tables"))
    target, everything = split_at_last_days(spark, folder)
    staging.write_staged(target, layout.staged)
    build.update_day_tables(spark, layout)
    staging.incremental_run(everything, layout.staged)
    build.build_marts(spark, layout)
    return layout


def marts_after_increment(spark: SparkSession, folder: str) -> DataFrame:
    """All four marts as they are stored, one JSON text a row."""
    return stored_marts(spark, incremented(spark, folder))


def marts_after_old_day(spark: SparkSession, folder: str) -> DataFrame:
    """The marts brought up to date after one of the first days turned out otherwise.

    At first a fifth of that day's events is missing, and the others are told of
    the next repo and actor, or as another type; an upsert puts them right.
    """
    events = workspace.pin(staging.stage_to_store(raw(spark, folder)), "staged")
    odd = F.to_date("created_at") == F.date_add(events.select(F.to_date(F.min("created_at"))).scalar(), 4)
    number = F.col("event_id").cast("bigint")
    wrong = events.where(~(odd & (number % 5 == 1))).withColumns(
        {
            "repo_id": F.when(odd, F.col("repo_id") + 1).otherwise(F.col("repo_id")),
            "actor_id": F.when(odd, F.col("actor_id") + 1).otherwise(F.col("actor_id")),
            "event_type": F.when(odd & (number % 3 == 0), "WatchEvent").otherwise(F.col("event_type")),
        }
    )
    layout = build.Layout(workspace.fresh_path(spark, "tables"))
    staging.write_staged(wrong, layout.staged)
    build.build_marts(spark, layout)
    merge_into(workspace.pin(events.where(odd), "corrected"), layout.staged)
    build.build_marts(spark, layout)
    return stored_marts(spark, layout)


def retention_after_retraction(spark: SparkSession, folder: str) -> DataFrame:
    """Retention of customers by month after their first days were taken back.

    Orders count at the first of their month. Those of the first year are at
    first told of the next customer; remade, they take that customer's first
    month away.
    """
    events = orders(spark, folder).withColumn("created_at", F.date_trunc("month", "created_at").cast("timestamp_ntz"))
    events = workspace.pin(events, "orders")
    first = F.year("created_at") == events.select(F.year(F.min("created_at"))).scalar()
    actor = F.when(first, F.col("actor_id") + 1).otherwise(F.col("actor_id"))
    root = workspace.fresh_path(spark, "tables")
    source, months, firsts, cells, mart_ = [f"{root}/{n}" for n in ("activity", "months", "firsts", "cells", "mart")]
    schema = daily.developer_activity(events).schema
    read = lambda only: tables.read_by_day(spark, source, schema, only)
    for told, days in ((events.withColumn("actor_id", actor), None), (events, events.where(first))):
        days = days and {row[0].date() for row in days.select("created_at").distinct().collect()}
        part = told if days is None else told.where(first)
        tables.write_by_day(daily.developer_activity(part), source, "actor_id", replace=days)
        increments.update_actor_months(spark, source, read, months)
        increments.update_cells(spark, months, firsts, cells)
    increments.update_retention(spark, cells, mart_)
    own = increments.MART_SCHEMAS["contributor_retention"]
    return tables.read_by_day(spark, mart_, own).select(*own.names)


def stored_marts(spark: SparkSession, layout: build.Layout) -> DataFrame:
    rows = None
    for name in build.MARTS:
        mart = build.read_mart(spark, layout, name)
        part = mart.select(
            F.lit(name).alias("mart"), F.to_json(F.struct(*sorted(mart.columns)), {"ignoreNullFields": "false"}).alias("row")
        )
        rows = part if rows is None else rows.unionByName(part)
    return rows


def rebuilt_marts(spark: SparkSession, folder: str) -> DataFrame:
    """A mart that was stored for fewer events and is replaced by a rebuild."""
    layout = incremented(spark, folder)
    staging.full_refresh(raw(spark, folder), layout.staged)
    build.build_marts(spark, layout)
    return build.read_mart(spark, layout, "label_usage")


def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Repeats dropped in a stream of all raw events, by bounded state."""
    store, out, position = [
        workspace.fresh_path(spark, label) for label in ("raw", "kept", "position")
    ]
    landing.as_stored(raw(spark, folder)).write.partitionBy("load_status").parquet(store)
    events = changes.raw_changes(spark, store).select(F.col("id").alias("event_id"), "created_at")
    query = (
        changes.drop_repeats(events)
        .select("event_id")
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", position)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema("event_id string").parquet(out)


TRENDING = [marts.trending_repos, mart("trending")]
TRENDS = [marts.category_trends, mart("trends")]
LABELS = [marts.label_usage, mart("labels")]

QUERIES: dict[str, Query] = {
    "raw_json_scan": raw_json_scan,
    "load_report": load_report,
    "backfill_result": backfill_result,
    "unloaded_files": unloaded_files,
    "hour_spine": hour_spine,
    "missing_hours": missing_hours,
    "stage_events": stage_events,
    "full_refresh": full_refresh,
    "dedup_events": dedup_events,
    "incremental_batch": incremental_batch,
    "upsert_result": upsert_result,
    "upsert_random_ids": upsert_random_ids,
    "cdc_upsert": cdc_upsert,
    "stream_upsert": stream_upsert,
    "late_rejects": late_rejects,
    "event_category_counts": event_category_counts,
    "pr_labels": on(staged, daily.pr_labels),
    "repo_daily_stats": on(staged, daily.repo_daily_stats),
    "developer_activity": on(orders, daily.developer_activity),
    "developer_activity_events": on(staged, daily.developer_activity),
    "category_daily": on(staged, daily.category_daily),
    "label_daily": on(staged, daily.pr_labels, daily.label_daily),
    "rolling_7d": on(staged, daily.repo_daily_stats, marts.rolling_7d),
    "rolling_7d_calendar": on(
        lineitem,
        daily.repo_daily_stats,
        lambda stats: marts.rolling_7d(stats, calendar=True),
    ),
    "first_seen_month": on(
        orders,
        daily.developer_activity,
        ranking.first_seen_month,
        lambda df: df.select("actor_id", "date_day", "cohort_month"),
    ),
    "trending_repos": on(staged, marts.trending_repos),
    "trending_parts": on(lineitem, marts.trending_repos),
    "cohort_retention": on(orders, marts.contributor_retention),
    "category_trends": on(staged, marts.category_trends),
    "category_trends_lineitem": on(lineitem, marts.category_trends),
    "label_usage": on(staged, marts.label_usage),
    "feed_trending": on(staged, *TRENDING, serving.feed_trending, shown("feed_trending")),
    "feed_trends": on(staged, *TRENDS, serving.feed_trends, shown("feed_trends")),
    "feed_labels": on(staged, *LABELS, serving.feed_labels, shown("feed_labels")),
    "insight_feed": insight_feed,
    "latest_insight": latest_insight,
    "insight_log": insight_log,
    "last_updated": on(staged, serving.last_updated),
    "available_days": on(staged, *TRENDING, serving.available_days),
    "trending_for_day": trending_for_day,
    "trends_30d": on(staged, *TRENDS, serving.trends_30d, shown("trends_30d")),
    "growth_points": on(staged, *TRENDS, serving.growth_points),
    "labels_latest": on(staged, *LABELS, serving.labels_latest, shown("labels_latest")),
    "labels_chart": on(staged, *LABELS, serving.labels_chart, shown("labels_chart")),
    "marts_after_increment": marts_after_increment,
    "marts_after_old_day": marts_after_old_day,
    "retention_after_retraction": retention_after_retraction,
    "rebuilt_marts": rebuilt_marts,
    "stream_dedup": stream_dedup,
    "dq_not_null": dq_not_null,
    "dq_unique": dq_unique,
    "dq_accepted_values": dq_accepted_values,
    "dq_report": dq_report,
    "dq_by_day": dq_by_day,
    "dq_freshness": dq_freshness,
}
