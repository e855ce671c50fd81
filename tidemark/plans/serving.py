"""Reads that the dashboard and the daily briefing make, and the briefing log."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.expressions import instant
from tidemark.operators.ranking import at_latest, trailing_days

INSIGHT_SCHEMA = T.StructType(
    [
        T.StructField("insight_date", T.DateType()),
        T.StructField("generated_at", T.TimestampNTZType()),
        T.StructField("insight_text", T.StringType()),
        T.StructField("model_used", T.StringType()),
    ]
)
# The ranked list that a briefing was written from, however long: one row per entry.
ITEM_SCHEMA = T.StructType(
    [
        T.StructField("generated_at", T.TimestampNTZType()),
        T.StructField("place", T.LongType()),
        T.StructField("item", T.VariantType()),
    ]
)

# The order in which each mart and read is shown. Tables are
# stored without it; ``-`` is descending.
SHOWN: dict[str, tuple[str, ...]] = {
    "contributor_retention": ("cohort_month", "months_since_first"),
    "category_trends": ("-date_day", "-event_count"),
    "label_usage": ("-date_day", "daily_rank"),
    "feed_trending": ("trending_rank",),
    "feed_trends": ("-date_day", "-event_count"),
    "feed_labels": ("daily_rank",),
    "trending_for_day": ("trending_rank",),
    "trends_30d": ("date_day", "-event_count"),
    "labels_latest": ("daily_rank",),
    "labels_chart": ("label_applied_count",),
    "insight_log": ("generated_at", "place", "item"),
}


def as_json(df: DataFrame) -> Column:
    """The row as a JSON object that names every column, NULL ones too."""
    return F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})


def in_order(df: DataFrame, read: str) -> DataFrame:
    """Sort a mart or a read for showing it."""
    return df.orderBy(
        *[F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in SHOWN[read]]
    )


def feed_trending(trending: DataFrame, limit: int = 10) -> DataFrame:
    return (
        at_latest(trending)
        .where(F.col("trending_rank") <= limit)
        .select(
            "repo_name",
            "rolling_7d_stars",
            "rolling_7d_forks",
            "unique_contributors",
            "trending_rank",
            "date_day",
        )
    )


def feed_trends(trends: DataFrame, days: int = 7) -> DataFrame:
    """``days`` is inclusive at both ends: 7 gives eight days, 30 gives 31."""
    return trailing_days(trends, days).select(
        "date_day", "event_category", "event_count", "wow_growth_rate"
    )


def trends_30d(trends: DataFrame) -> DataFrame:
    return feed_trends(trends, 30)


def feed_labels(labels: DataFrame, limit: int = 10) -> DataFrame:
    return (
        at_latest(labels)
        .where(F.col("daily_rank") <= limit)
        .select("label_name", "label_applied_count", "unique_repos", "daily_rank")
    )


def labels_latest(labels: DataFrame) -> DataFrame:
    return feed_labels(labels, 20)


def insight_feed(trending: DataFrame, trends: DataFrame, labels: DataFrame) -> DataFrame:
    """The three feeds as JSON objects, one per row, named by section.

    Ranked sections may be long through ties, so they are not folded into one
    document.
    """
    sections = {
        "trending_repos": feed_trending(trending),
        "language_trends": feed_trends(trends),
        "label_usage": feed_labels(labels),
    }
    feed = None
    for section, rows in sections.items():
        items = rows.select(
            F.lit(section).alias("section"), as_json(rows).alias("item")
        )
        feed = items if feed is None else feed.unionByName(items)
    return feed


def last_updated(staged: DataFrame) -> DataFrame:
    return staged.agg(F.max("created_at").alias("last_updated"))


def available_days(trending: DataFrame, limit: int = 90) -> DataFrame:
    return trending.select("date_day").distinct().orderBy(F.desc("date_day")).limit(limit)


def trending_for_day(trending: DataFrame, day: date | Column, limit: int = 20) -> DataFrame:
    day = F.lit(day) if isinstance(day, date) else day
    return trending.where((F.col("date_day") == day) & (F.col("trending_rank") <= limit)).select(
        "repo_name", "rolling_7d_stars", "rolling_7d_forks", "unique_contributors", "trending_rank"
    )


def growth_points(trends: DataFrame) -> DataFrame:
    """The rows of the 30-day trends that have a growth rate."""
    return trends_30d(trends).dropna(subset=["wow_growth_rate"])


def labels_chart(labels: DataFrame) -> DataFrame:
    """The latest labels as the chart reads them; shown by rising count."""
    return labels_latest(labels).select("label_name", "label_applied_count")


def append_insight(
    trending: DataFrame,
    path: str,
    text: str,
    model: str,
    generated_at: datetime | None = None,
) -> None:
    """Append one briefing and the ranked list it was written from.

    Date and time default to now. ``text`` comes from the caller. The entries
    are written first, so that a briefing is never without them; those of a run
    that died before the briefing belong to none.
    """
    spark = trending.sparkSession
    if generated_at is None:
        now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()).cast("timestamp_ntz")
        generated_at = spark.range(1).select(now).first()[0]
    at = instant(generated_at)
    top = feed_trending(trending)
    items = top.select(
        at.alias("generated_at"),
        F.col("trending_rank").cast("bigint").alias("place"),
        F.parse_json(as_json(top)).alias("item"),
    )
    items.write.mode("append").parquet(f"{path}/items")
    briefing = spark.range(1).select(
        F.to_date(at).alias("insight_date"),
        at.alias("generated_at"),
        F.lit(text).alias("insight_text"),
        F.lit(model).alias("model_used"),
    )
    briefing.write.mode("append").parquet(f"{path}/briefings")


def insights(spark: SparkSession, path: str) -> DataFrame:
    """All briefings."""
    return spark.read.schema(INSIGHT_SCHEMA).parquet(f"{path}/briefings")


def latest_insight(spark: SparkSession, path: str) -> DataFrame:
    newest = insights(spark, path).orderBy(F.desc("generated_at")).limit(1)
    return newest.select("insight_text", "generated_at", "model_used")


def insight_log(spark: SparkSession, path: str) -> DataFrame:
    """Every entry of every briefing's list, by place, as JSON text."""
    items = spark.read.schema(ITEM_SCHEMA).parquet(f"{path}/items")
    told = insights(spark, path).select("generated_at").distinct()
    return items.join(told, "generated_at").select(
        "generated_at", "place", F.to_json("item").alias("item")
    )
