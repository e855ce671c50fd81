"""The four marts, composed from the day-grain operators."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window, functions as F

from tidemark import workspace
from tidemark.functions.expressions import (
    EVENT_CATEGORIES,
    month_of,
    months_apart,
    safe_divide,
)
from tidemark.operators.daily import (
    category_daily,
    developer_activity,
    label_daily,
    pr_labels,
    repo_daily_stats,
)
from tidemark.operators.ranking import (
    change_over_rows,
    first_seen_month,
    rolling_sums,
    top_ranked,
)

ROLLING = {
    "rolling_7d_stars": "star_count",
    "rolling_7d_forks": "fork_count",
    "rolling_7d_code_events": "code_event_count",
}
TRENDING_COLUMNS = ("repo_id", "repo_name", "date_day", "star_count", *ROLLING, "unique_contributors")


def rolling_7d(stats: DataFrame, entity: str = "repo_id", calendar: bool = False) -> DataFrame:
    return rolling_sums(stats, ROLLING, key=entity, calendar=calendar)


def trending_repos(
    events: DataFrame,
    limit: int = 100,
    mapping: Mapping[str, str] = EVENT_CATEGORIES,
    calendar: bool = False,
) -> DataFrame:
    """Entities ranked per day by stars over their last seven active days."""
    return trending_of(repo_daily_stats(events, mapping), limit, calendar)


def trending_of(stats: DataFrame, limit: int = 100, calendar: bool = False) -> DataFrame:
    """The same from the day-grain table. Runs a job when called: the rolling
    sums are stored, as they are read by value and by row.

    Ties share a rank and all stay, so a day may hold more than ``limit`` rows.
    """
    pinned = workspace.pin(rolling_7d(stats, calendar=calendar).select(*TRENDING_COLUMNS), "rolling")
    return ranked_by_stars(pinned, limit)


def ranked_by_stars(rolling: DataFrame, limit: int = 100) -> DataFrame:
    """Stored rolling sums ranked per day. Runs a job when called."""
    return top_ranked(rolling.select(*TRENDING_COLUMNS), "date_day", "rolling_7d_stars", limit, "trending_rank")


def cohort_retention(activity: DataFrame, actor: str = "actor_id") -> DataFrame:
    """Actors of each first-seen month still active in each later month.

    NULL actors are not counted but their contributions are, so a cohort of
    only NULL actors has size 0 and no rate.
    """
    by_month = (
        first_seen_month(activity, actor)
        .withColumn("activity_month", month_of(F.col("date_day")))
        .groupBy("cohort_month", "activity_month")
        .agg(
            F.count_distinct(F.col(actor)).alias("retained_contributors"),
            F.sum("code_contributions").alias("total_code_contributions"),
        )
    )
    return retention_rates(by_month)


def retention_rates(by_month: DataFrame) -> DataFrame:
    """The mart from its counts per cohort and activity month."""
    by_month = by_month.withColumn(
        "months_since_first", months_apart(F.col("cohort_month"), F.col("activity_month"))
    )
    in_cohort = Window.partitionBy("cohort_month").orderBy(
        F.col("months_since_first").asc_nulls_last()
    )
    return by_month.withColumn(
        "cohort_size", F.first("retained_contributors").over(in_cohort)
    ).select(
        "cohort_month",
        "activity_month",
        "months_since_first",
        "cohort_size",
        "retained_contributors",
        safe_divide(F.col("retained_contributors"), F.col("cohort_size")).alias("retention_rate"),
        "total_code_contributions",
    )


def contributor_retention(
    events: DataFrame, mapping: Mapping[str, str] = EVENT_CATEGORIES
) -> DataFrame:
    return cohort_retention(developer_activity(events, mapping))


def growth(daily: DataFrame, rows: int = 7) -> DataFrame:
    """Week-over-week change per category, seven stored days back."""
    return change_over_rows(
        daily,
        value="event_count",
        key="event_category",
        day="date_day",
        rows=rows,
        before="event_count_7d_ago",
        rate="wow_growth_rate",
    )


def category_trends(
    events: DataFrame, mapping: Mapping[str, str] = EVENT_CATEGORIES
) -> DataFrame:
    return growth(category_daily(events, mapping))


def label_usage(events: DataFrame, limit: int = 20) -> DataFrame:
    """Labels ranked per day by applications; ties stay."""
    return labels_of(label_daily(pr_labels(events)), limit)


def labels_of(daily: DataFrame, limit: int = 20) -> DataFrame:
    """The same from the day-grain table. Runs a job when called."""
    daily = workspace.pin(daily, "label-daily")
    return top_ranked(daily, "date_day", "label_applied_count", limit, "daily_rank").select(
        "date_day",
        "label_name",
        "label_applied_count",
        "unique_repos",
        "unique_prs",
        "daily_rank",
    )
