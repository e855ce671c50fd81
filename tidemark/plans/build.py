"""The whole job: load, stage, rebuild the marts, check."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from datetime import date, datetime, time, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark import tables, workspace
from tidemark.functions.expressions import instant
from tidemark.operators import daily, quality
from tidemark.plans import checks, increments, serving, staging
from tidemark.sources import hours, landing

Build = Callable[[DataFrame], DataFrame]


def _labels_by_day(events: DataFrame) -> DataFrame:
    return daily.with_day(daily.pr_labels(events))


# Tables with one partition a day, each day made from that day's staged events;
# and the column that a day's files are sorted by.
DAY_TABLES: Mapping[str, tuple[Build, str]] = {
    "repo_daily_stats": (daily.repo_daily_stats, "repo_id"),
    "developer_activity": (daily.developer_activity, "actor_id"),
    "category_daily": (daily.category_daily, "event_category"),
    "pr_labels": (_labels_by_day, "label_name"),
    "label_daily": (lambda events: daily.label_daily(daily.pr_labels(events)), "label_name"),
}

MARTS = tuple(increments.MART_SCHEMAS)


@dataclass(frozen=True)
class Layout:
    """Where the tables lie."""

    root: str

    @property
    def raw(self) -> str:
        return f"{self.root}/raw_events"

    @property
    def ledger(self) -> str:
        return f"{self.root}/load_ledger"

    @property
    def staged(self) -> str:
        return f"{self.root}/staged_events"

    @property
    def insights(self) -> str:
        return f"{self.root}/daily_insights"

    @property
    def seen(self) -> str:
        """Which version of each staged day the day tables were made from."""
        return f"{self.root}/day_tables/_seen"

    def day_table(self, name: str) -> str:
        return f"{self.root}/day_tables/{name}"

    def mart(self, name: str) -> str:
        return f"{self.root}/marts/{name}"

    @property
    def snapshot(self) -> str:
        """Which state of each mart is shown."""
        return f"{self.root}/marts/_snapshot"

    @property
    def checked(self) -> str:
        """What the checks found on each day."""
        return f"{self.root}/day_tables/_checked"


class ChecksFailed(Exception):
    """A check of severity ``error`` failed; the failed rows are the argument."""


def stage(spark: SparkSession, layout: Layout, since: datetime | None = None) -> None:
    """One incremental run from the raw table, if anything was ever loaded.

    Of the raw table the folders are opened that the ledger names and that may
    hold an event behind the bound.
    """
    bound = staging.reach_back(spark, layout.staged, since=since)
    if bound is None:
        paths = landing.loaded_folders(spark, layout.raw, layout.ledger)
        staging.full_refresh(landing.raw_of(spark, layout.raw, paths), layout.staged, stored=bool(paths))
        return
    staging.upsert_raw(raw_behind(spark, layout, bound), layout.staged)
    tables.remove_old(spark, layout.staged)


def raw_behind(spark: SparkSession, layout: Layout, bound: datetime) -> DataFrame:
    """Raw events later than ``bound``, from the hour folders that have some."""
    paths = landing.loaded_folders(spark, layout.raw, layout.ledger, after=bound)
    return landing.raw_of(spark, layout.raw, paths).where(F.col("created_at") > instant(bound))


def stale_days(spark: SparkSession, layout: Layout) -> set[date | None]:
    """Days whose staged version is not the one that the day tables were made from."""
    now, seen = tables.versions(spark, layout.staged), tables.versions(spark, layout.seen)
    return {day for day in now.keys() | seen.keys() if now.get(day) != seen.get(day)}


def update_day_tables(spark: SparkSession, layout: Layout) -> set[date | None]:
    """Make the stale days of all day tables anew from those days' events.

    What was seen is noted last, so that a run that dies is made good by the next.
    """
    versions = tables.versions(spark, layout.staged)
    stale = stale_days(spark, layout)
    if stale or not tables.published(spark, layout.seen):
        events = staging.read_staged(spark, layout.staged, stale)
        for name, (build, key) in DAY_TABLES.items():
            tables.write_by_day(build(events), layout.day_table(name), key, replace=stale)
            tables.remove_old(spark, layout.day_table(name))
        tables.publish(spark, layout.seen, versions)
    return stale


def read_day_table(
    spark: SparkSession, layout: Layout, name: str, only: Iterable[date | None] | None = None
) -> DataFrame:
    build, _ = DAY_TABLES[name]
    made = build(spark.createDataFrame([], staging.STAGED_SCHEMA))
    return tables.read_by_day(spark, layout.day_table(name), made.schema, only).select(*made.columns)


def build_marts(spark: SparkSession, layout: Layout) -> None:
    """Bring the day tables and the marts up to date, and show the marts together."""
    update_day_tables(spark, layout)
    at = layout.day_table
    day_table = lambda name: (at(name), _day_reader(spark, layout, name))
    steps = (
        lambda: increments.update_rolling(spark, *day_table("repo_daily_stats"), at("rolling_7d")),
        lambda: increments.update_trending(spark, at("rolling_7d"), layout.mart("trending_repos")),
        lambda: increments.update_actor_months(spark, *day_table("developer_activity"), at("actor_months")),
        lambda: increments.update_cells(spark, at("actor_months"), at("first_months"), at("retention_cells")),
        lambda: increments.update_retention(spark, at("retention_cells"), layout.mart("contributor_retention")),
        lambda: increments.update_trends(spark, *day_table("category_daily"), layout.mart("category_trends")),
        lambda: increments.update_labels(spark, *day_table("label_daily"), layout.mart("label_usage")),
    )
    for step in steps:
        with workspace.scoped(spark):
            step()
    increments.publish_snapshot(spark, layout.snapshot, {name: layout.mart(name) for name in MARTS})


def read_mart(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    """A mart as it was last shown; all four are of one state."""
    return increments.read_mart(spark, layout.snapshot, name, layout.mart(name))


def register_views(spark: SparkSession, layout: Layout) -> None:
    """Name the stored tables for ``spark.sql``."""
    staging.read_staged(spark, layout.staged).createOrReplaceTempView("staged_events")
    for name in MARTS:
        read_mart(spark, layout, name).createOrReplaceTempView(name)
    if tables.exists(spark, layout.insights):
        serving.insights(spark, layout.insights).createOrReplaceTempView("daily_insights")


def check_all(
    spark: SparkSession,
    layout: Layout,
    raw: bool = False,
    as_of: datetime | Column | None = None,
) -> DataFrame:
    """All declared checks on the stored tables, and how fresh the raw table is.

    Of the staged and the day tables the days are read whose version was not
    checked yet; what was found on the others is stored. ``raw`` also checks the
    raw table, which groups all of it by id. ``as_of`` defaults to now.
    """
    by_day = {
        "staged_events": lambda only: staging.read_staged(spark, layout.staged, only),
        **{n: _day_reader(spark, layout, n) for n in DAY_TABLES if n in quality.CHECKS},
    }
    with workspace.scoped(spark):
        checks.update(spark, layout.checked, layout.staged, staging.STAGED_SCHEMA, by_day)
    report = checks.report(spark, layout.checked, layout.staged, by_day)
    models = {name: read_mart(spark, layout, name) for name in MARTS}
    if raw:
        models = {"raw_events": landing.raw_events(spark, layout.raw, layout.ledger), **models}
    now = datetime.now(timezone.utc).replace(tzinfo=None) if as_of is None else as_of
    newest = landing.newest_loaded(spark, layout.ledger)
    fresh = quality.freshness_check("raw_events", quality.freshness(newest, now))
    return report.unionByName(quality.quality_report(models)).unionByName(fresh)


def _day_reader(spark: SparkSession, layout: Layout, name: str) -> increments.Read:
    return lambda only: read_day_table(spark, layout, name, only)


def require_passed(report: DataFrame) -> None:
    """Raise if a check from the staged table on failed. Raw repeats do not
    count, as removing them is what staging is for, nor does the raw table's age."""
    bad = quality.failed(report).where("model <> 'raw_events'").collect()
    if bad:
        raise ChecksFailed(bad)


def run(
    spark: SparkSession,
    landing_root: str,
    layout: Layout,
    start: datetime | None = None,
    end: datetime | None = None,
    since: datetime | None = None,
    history_days: int | None = None,
    check_raw: bool = False,
    as_of: datetime | None = None,
) -> DataFrame:
    """Load an hour range (by default the last complete hour), stage what is
    new, remake the touched days and the marts, and return the check report.

    ``since`` stages older events too, after a backfill. ``history_days`` is how
    long loaded files are remembered.
    """
    if start is None and end is None:
        start = end = hours.previous_hour()
    with workspace.scoped(spark):
        landing.load_hours(
            spark, landing_root, layout.raw, layout.ledger, start, end, history_days
        )
    stage(spark, layout, since)
    build_marts(spark, layout)
    return check_all(spark, layout, check_raw, as_of)


def backfill(
    spark: SparkSession,
    landing_root: str,
    layout: Layout,
    first: date,
    last: date,
    history_days: int | None = None,
) -> DataFrame:
    """Load and stage all hours of the days from ``first`` to ``last``, remake
    the touched days and the marts, and return the hours that had no file.

    Whatever the files of these hours hold is staged, events of other days too.
    """
    start, end = datetime.combine(first, time()), datetime.combine(last, time(23))
    with workspace.scoped(spark):
        landing.load_hours(
            spark, landing_root, layout.raw, layout.ledger, start, end, history_days
        )
    stage_hours(spark, layout, start, end)
    build_marts(spark, layout)
    ledger = landing.read_ledger(spark, layout.ledger, only=landing.days_between(start, end))
    return hours.missing_hours(hours.hour_spine(spark, first, last), landing.loaded_hours(ledger))


def stage_hours(spark: SparkSession, layout: Layout, start: datetime, end: datetime) -> None:
    """Stage all that the files of an hour range hold; without a staged table, all there is."""
    if staging.reach_back(spark, layout.staged) is None:
        stage(spark, layout)
    else:
        staging.upsert_raw(landing.raw_events(spark, layout.raw, layout.ledger, start, end), layout.staged)
        tables.remove_old(spark, layout.staged)
