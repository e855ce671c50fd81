"""The marts kept up to date from what changed, as one snapshot.

Each step compares the versions of its source's days with those it was last made
from, remakes what the changed days reach, and notes the versions last: a run
that dies is made good by the next. Steps write day tables beside their old
versions; readers of the marts go by a snapshot that names one manifest of each,
published when all are done, so they see the old marts or the new ones, never a
mixture.

- Rolling sums of a changed (repo, day) reach that repo's next six active days.
  Those rows are made anew from the history of the changed repos; the ranking of
  the days they lie on is made anew from the stored sums.
- Actors by month are made anew for the months of changed days. Of actors in those
  months, now or before, the first month is found again, since a remade day may
  bring one or take one away. Counts per cohort are made anew for those months, and
  for the months in which an actor was active whose first month is another now.
- Labels are ranked per day; category trends are a few rows a day and made as a whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark import tables, workspace
from tidemark.functions.expressions import month_of
from tidemark.operators import ranking
from tidemark.plans import marts

DAY = tables.DAY
#: Reads a day table, or some of its days.
Read = Callable[[Iterable[date | None] | None], DataFrame]
COUNTS = ("star_count", "fork_count", "code_event_count")


TYPES = {"long": T.LongType(), "double": T.DoubleType(), "string": T.StringType(), "date": T.DateType()}


def schema(fields: str) -> T.StructType:
    """Columns from ``name type, ...``, without a session."""
    pairs = [field.split() for field in fields.split(",")]
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


MART_SCHEMAS: Mapping[str, T.StructType] = {
    "trending_repos": schema(
        "repo_id long, repo_name string, date_day date, star_count long, rolling_7d_stars long, rolling_7d_forks long, "
        "rolling_7d_code_events long, unique_contributors long, trending_rank long"
    ),
    "contributor_retention": schema(
        "cohort_month date, activity_month date, months_since_first long, cohort_size long, retained_contributors long, "
        "retention_rate double, total_code_contributions long"
    ),
    "category_trends": schema(
        "date_day date, event_category string, event_count long, unique_contributors long, unique_repos long, "
        "event_count_7d_ago long, wow_growth_rate double"
    ),
    "label_usage": schema(
        "date_day date, label_name string, label_applied_count long, unique_repos long, unique_prs long, daily_rank long"
    ),
}
ROLLING_SCHEMA = schema(
    "repo_id long, repo_name string, date_day date, star_count long, fork_count long, code_event_count long, "
    "rolling_7d_stars long, rolling_7d_forks long, rolling_7d_code_events long, unique_contributors long"
)
#: Of these the partition is a month.
ACTOR_MONTHS = schema("actor_id long, days long, code_contributions long, date_day date")
FIRST_MONTHS = schema("actor_id long, date_day date")
CELLS = schema("cohort_month date, retained_contributors long, total_code_contributions long, date_day date")


def stale(spark: SparkSession, source: str, made: str) -> tuple[dict[date | None, str], set[date | None]]:
    """Versions of the source's days, and the days that ``made`` was made from other versions of."""
    now, seen = tables.versions(spark, source), tables.versions(spark, f"{made}_seen")
    return now, {day for day in now.keys() | seen.keys() if now.get(day) != seen.get(day)}


def note(spark: SparkSession, made: str, versions: Mapping[date | None, str]) -> None:
    tables.publish(spark, f"{made}_seen", dict(versions))


def untouched(spark: SparkSession, made: str, days: set[date | None]) -> bool:
    return not days and tables.published(spark, f"{made}_seen")


def on_pair(left: DataFrame, right: DataFrame, *columns: str, how: str) -> DataFrame:
    """Join on columns that may be NULL; the columns of ``left`` stay."""
    found = right.select(*[F.col(c).alias(f"_{c}") for c in columns])
    same: Column = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return left.join(found, same, how)


def days_of(df: DataFrame, column: str = DAY) -> set[date | None]:
    """Collected: one row a day."""
    return {row[0] for row in df.select(column).distinct().collect()}


def update_rolling(spark: SparkSession, source: str, read: Read, path: str) -> None:
    """Rolling sums per repo and active day, brought up to date with the repo-day table at ``source``."""
    versions, days = stale(spark, source, path)
    if untouched(spark, path, days):
        return
    own = ("repo_id", "repo_name", DAY, *COUNTS, "unique_contributors")
    rows = read(None).select(*own)
    if not tables.published(spark, path):
        tables.write_by_day(marts.rolling_7d(rows).select(*ROLLING_SCHEMA.names), path, "repo_id")
    else:
        before = tables.read_by_day(spark, path, ROLLING_SCHEMA, days).select(*own)
        after = read(days).select(*own)
        changed = before.exceptAll(after).unionByName(after.exceptAll(before)).select("repo_id", DAY).distinct()
        changed = workspace.pin(changed, "changed")
        history = on_pair(rows, changed.select("repo_id").distinct(), "repo_id", how="left_semi")
        history = workspace.pin(history, "history")
        reached = workspace.pin(ranking.reached_rows(history, changed), "reached")
        again = days_of(reached) | days_of(changed)
        if again:
            fresh = on_pair(marts.rolling_7d(history), reached, "repo_id", DAY, how="left_semi")
            kept = tables.read_by_day(spark, path, ROLLING_SCHEMA, again)
            gone = reached.unionByName(changed)
            kept = on_pair(kept, gone, "repo_id", DAY, how="left_anti").select(*ROLLING_SCHEMA.names)
            tables.write_by_day(kept.unionByName(fresh.select(*kept.columns)), path, "repo_id", replace=again)
            tables.remove_old(spark, path)
    note(spark, path, versions)


def update_trending(spark: SparkSession, source: str, path: str) -> None:
    """Days ranked anew whose rolling sums changed."""
    versions, days = stale(spark, source, path)
    if untouched(spark, path, days):
        return
    rolling = tables.read_by_day(spark, source, ROLLING_SCHEMA, days)
    tables.write_by_day(marts.ranked_by_stars(rolling), path, "trending_rank", replace=days)
    note(spark, path, versions)


def update_labels(spark: SparkSession, source: str, read: Read, path: str) -> None:
    versions, days = stale(spark, source, path)
    if untouched(spark, path, days):
        return
    tables.write_by_day(marts.labels_of(read(days)), path, "daily_rank", replace=days)
    note(spark, path, versions)


def update_trends(spark: SparkSession, source: str, read: Read, path: str) -> None:
    versions, days = stale(spark, source, path)
    if untouched(spark, path, days):
        return
    tables.write_by_day(marts.growth(read(None)), path, "event_category")
    note(spark, path, versions)


def months_of(days: set[date | None]) -> set[date | None]:
    return {None if day is None else day.replace(day=1) for day in days}


def update_actor_months(spark: SparkSession, source: str, read: Read, path: str) -> None:
    """Actors and their contributions per month, remade for the months of changed days."""
    versions, days = stale(spark, source, path)
    if untouched(spark, path, days):
        return
    months = months_of(days)
    wanted = [day for day in versions if months_of({day}) <= months]
    own = read(wanted).groupBy("actor_id", month_of(F.col(DAY)).alias("month"))
    made = own.agg(F.count("*").alias("days"), F.sum("code_contributions").alias("code_contributions"))
    tables.write_by_day(made.withColumnRenamed("month", DAY), path, "actor_id", replace=months)
    tables.remove_old(spark, path)
    note(spark, path, versions)


def update_cells(spark: SparkSession, source: str, firsts: str, path: str) -> None:
    """Counts per cohort and month from actors by month, at ``source``, with each actor's first month kept at ``firsts``.

    The months whose counts change are noted before the first months are
    published, so that they are remade also if the run dies in between.
    """
    versions, months = stale(spark, source, path)
    if untouched(spark, path, months):
        return
    actors = tables.read_by_day(spark, source, ACTOR_MONTHS)
    known = tables.read_by_day(spark, firsts, FIRST_MONTHS)
    if not tables.published(spark, firsts):
        moved, again = None, set(versions)
        found = actors.groupBy("actor_id").agg(F.min(DAY).alias(DAY))
    else:
        # Who is in the changed months, and whose first month was one of them.
        touched = tables.read_by_day(spark, source, ACTOR_MONTHS, months).select("actor_id")
        touched = touched.unionByName(tables.read_by_day(spark, firsts, FIRST_MONTHS, months).select("actor_id")).distinct()
        touched = workspace.pin(touched, "touched")
        own = on_pair(actors, touched, "actor_id", how="left_semi")
        found = own.groupBy("actor_id").agg(F.min(DAY).alias(DAY))
        had = on_pair(known, touched, "actor_id", how="left_semi").select(*found.columns)
        gone, come = had.exceptAll(found), found.exceptAll(had)
        moved = workspace.pin(
            gone.withColumn("come", F.lit(False)).unionByName(come.withColumn("come", F.lit(True))), "moved"
        )
        again = months | days_of(on_pair(actors, moved.select("actor_id").distinct(), "actor_id", how="left_semi"))
        again |= read_months(spark, path)
    publish_months(spark, path, again)
    if moved is None:
        tables.write_by_day(found, firsts, "actor_id")
    else:
        cohorts = days_of(moved)
        if cohorts:
            kept = tables.read_by_day(spark, firsts, FIRST_MONTHS, cohorts)
            kept = on_pair(kept, moved.where("NOT come"), "actor_id", how="left_anti").select("actor_id", DAY)
            come = moved.where("come").select("actor_id", DAY)
            tables.write_by_day(kept.unionByName(come), firsts, "actor_id", replace=cohorts)
            tables.remove_old(spark, firsts)
    cohort = tables.read_by_day(spark, firsts, FIRST_MONTHS).select(
        F.col("actor_id").alias("_actor"), F.col(DAY).alias("cohort_month")
    )
    active = tables.read_by_day(spark, source, ACTOR_MONTHS, again)
    cells = active.join(cohort, F.col("actor_id").eqNullSafe(F.col("_actor"))).groupBy("cohort_month", DAY).agg(
        F.count("actor_id").alias("retained_contributors"), F.sum("code_contributions").alias("total_code_contributions")
    )
    tables.write_by_day(cells.select(*CELLS.names), path, "cohort_month", replace=again)
    tables.remove_old(spark, path)
    note(spark, path, versions)
    publish_months(spark, path, set())


def publish_months(spark: SparkSession, path: str, months: set[date | None]) -> None:
    tables.publish(spark, f"{path}_pending", dict.fromkeys(months, "pending"))


def read_months(spark: SparkSession, path: str) -> set[date | None]:
    """Months whose counts a run that died had still to make."""
    return set(tables.versions(spark, f"{path}_pending"))


def update_retention(spark: SparkSession, cells: str, path: str) -> None:
    versions, months = stale(spark, cells, path)
    if untouched(spark, path, months):
        return
    counts = tables.read_by_day(spark, cells, CELLS).withColumnRenamed(DAY, "activity_month")
    mart = marts.retention_rates(counts).withColumn(DAY, F.col("cohort_month"))
    tables.write_by_day(mart, path, "activity_month")
    note(spark, path, versions)


def publish_snapshot(spark: SparkSession, path: str, mart_paths: Mapping[str, str]) -> None:
    """Name one manifest of each mart, all at once, and delete what the last two snapshots don't name."""
    now = {name: str(tables.newest_number(spark, mart)) for name, mart in mart_paths.items()}
    if tables.read_names(spark, path) != now:
        tables.publish_names(spark, path, now)
    before = tables.read_names(spark, path, back=1)
    for name, mart in mart_paths.items():
        tables.remove_old(spark, mart, numbers={int(now[name]), int(before.get(name, now[name]))})


def read_mart(spark: SparkSession, snapshot: str, name: str, path: str) -> DataFrame:
    """A mart as of the newest snapshot."""
    number = tables.read_names(spark, snapshot).get(name)
    if number is None:
        raise LookupError(f"no marts have been published at {snapshot}")
    own = MART_SCHEMAS[name]
    return tables.read_by_day(spark, path, own, number=int(number)).select(*own.names)
