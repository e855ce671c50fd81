"""Event-grain tables reduced to day grain.

Every distinct count is first spread over (group, counted value), so a group
that holds a third of all events is not reduced by one task.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.expressions import (
    EVENT_CATEGORIES,
    count_category,
    day_of,
    event_category,
    latest,
    safe_divide,
    surrogate_key,
)


def with_day(events: DataFrame, at: str = "created_at") -> DataFrame:
    return events.withColumn("date_day", day_of(F.col(at)))


def repo_daily_stats(
    events: DataFrame,
    mapping: Mapping[str, str] = EVENT_CATEGORIES,
    entity: str = "repo_id",
    name: str = "repo_name",
    actor: str = "actor_id",
    at: str = "created_at",
) -> DataFrame:
    """One row per entity and day, named as of the day's last event.

    Grouped by id and day only: a rename within the day does not split the row.
    """
    kind = F.col("event_type")
    day = with_day(events, at)
    stats = day.groupBy(entity, "date_day").agg(
        latest(F.col(name), F.col(at)).alias(name),
        count_category(kind, "star", mapping).alias("star_count"),
        count_category(kind, "fork", mapping).alias("fork_count"),
        count_category(kind, "code", mapping).alias("code_event_count"),
        count_category(kind, "issue", mapping).alias("issue_count"),
        count_category(kind, "release", mapping).alias("release_count"),
        F.count_distinct(F.col(actor)).alias("unique_contributors"),
        F.count("*").alias("total_events"),
    )
    return stats.select(
        surrogate_key(F.col(entity), F.col("date_day")).alias("surrogate_key"), "*"
    )


def developer_activity(
    events: DataFrame,
    mapping: Mapping[str, str] = EVENT_CATEGORIES,
    actor: str = "actor_id",
    login: str = "actor_login",
    entity: str = "repo_id",
    at: str = "created_at",
) -> DataFrame:
    """One row per actor and day."""
    kind = F.col("event_type")
    day = with_day(events, at)
    activity = day.groupBy(actor, "date_day").agg(
        latest(F.col(login), F.col(at)).alias(login),
        F.count("*").alias("total_events"),
        count_category(kind, "code", mapping).alias("code_contributions"),
        count_category(kind, "issue", mapping).alias("issue_interactions"),
        count_category(kind, "star", mapping).alias("stars_given"),
        F.count_distinct(F.col(entity)).alias("unique_repos_touched"),
    )
    return activity.select(
        surrogate_key(F.col(actor), F.col("date_day")).alias("surrogate_key"),
        "*",
        safe_divide(F.col("code_contributions"), F.col("total_events")).alias(
            "code_contribution_ratio"
        ),
    )


def category_daily(
    events: DataFrame,
    mapping: Mapping[str, str] = EVENT_CATEGORIES,
    actor: str = "actor_id",
    name: str = "repo_name",
    at: str = "created_at",
) -> DataFrame:
    """Events, distinct actors and distinct entity names per day and category."""
    day = with_day(events, at).withColumn(
        "event_category", event_category(F.col("event_type"), mapping)
    )
    return day.groupBy("date_day", "event_category").agg(
        F.count("*").alias("event_count"),
        F.count_distinct(F.col(actor)).alias("unique_contributors"),
        F.count_distinct(F.col(name)).alias("unique_repos"),
    )


def pr_labels(events: DataFrame) -> DataFrame:
    """One row per label of each labelling event.

    A missing, NULL, scalar or empty label list gives no row. A NULL element or
    a label without a name gives a row with a NULL name, which the declared
    checks report.
    """
    labeled = events.where(
        (F.col("event_type") == "PullRequestEvent")
        & (F.try_variant_get("payload", "$.action", "string") == "labeled")
    ).select(
        "event_id",
        "repo_id",
        "repo_name",
        "actor_id",
        "created_at",
        F.try_variant_get("payload", "$.pull_request.number", "bigint").alias("pr_number"),
        F.try_variant_get("payload", "$.labels", "variant").alias("labels"),
    )
    element = events.sparkSession.tvf.variant_explode(F.col("labels").outer())
    return labeled.lateralJoin(element).select(
        "event_id",
        "repo_id",
        "repo_name",
        "actor_id",
        "created_at",
        "pr_number",
        F.try_variant_get("value", "$.name", "string").alias("label_name"),
        F.try_variant_get("value", "$.color", "string").alias("label_color"),
        F.when(F.col("key").isNull(), F.col("pos")).cast("bigint").alias("label_position"),
    )


def label_daily(labels: DataFrame, at: str = "created_at") -> DataFrame:
    """Applications, distinct repos and distinct events per day and label.

    ``unique_prs`` counts labelling events, as its definition always did.
    """
    return (
        with_day(labels, at)
        .groupBy("date_day", "label_name")
        .agg(
            F.count("*").alias("label_applied_count"),
            F.count_distinct(F.col("repo_id")).alias("unique_repos"),
            F.count_distinct(F.col("event_id")).alias("unique_prs"),
        )
    )
