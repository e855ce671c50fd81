"""Column builders shared by the operators. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, functions as F

# Event type -> activity category.
EVENT_CATEGORIES: dict[str, str] = {
    "WatchEvent": "star",
    "ForkEvent": "fork",
    "PushEvent": "code",
    "PullRequestEvent": "code",
    "PullRequestReviewEvent": "code",
    "PullRequestReviewCommentEvent": "code",
    "CommitCommentEvent": "code",
    "IssuesEvent": "issue",
    "IssueCommentEvent": "issue",
    "CreateEvent": "repo_activity",
    "DeleteEvent": "repo_activity",
    "PublicEvent": "repo_activity",
    "ReleaseEvent": "release",
    "MemberEvent": "community",
    "SponsorshipEvent": "community",
    "GollumEvent": "wiki",
}
OTHER = "other"

# Stands for NULL inside a surrogate key.
NULL_KEY_PART = "_null_"


def types_of(category: str, mapping: Mapping[str, str] = EVENT_CATEGORIES) -> list[str]:
    return [event_type for event_type, name in mapping.items() if name == category]


def event_category(
    event_type: Column, mapping: Mapping[str, str] = EVENT_CATEGORIES, default: str = OTHER
) -> Column:
    """Category of an event type; unknown types and NULL become ``default``."""
    result = None
    for category in dict.fromkeys(mapping.values()):
        member = event_type.isin(types_of(category, mapping))
        result = F.when(member, category) if result is None else result.when(member, category)
    return result.otherwise(default) if result is not None else F.lit(default)


def count_category(
    event_type: Column, category: str, mapping: Mapping[str, str] = EVENT_CATEGORIES
) -> Column:
    """Number of rows in a category, by membership of the type itself."""
    return F.count_if(event_type.isin(types_of(category, mapping)))


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Ratio as double; NULL when the denominator is 0 or NULL."""
    return F.try_divide(numerator, denominator)


def instant(value: datetime) -> Column:
    """A zoneless timestamp literal, whatever the session and Python zones are."""
    return F.lit(value.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")


def day_of(at: Column) -> Column:
    return F.to_date(at)


def month_of(day: Column) -> Column:
    return F.trunc(day, "MM")


def months_apart(start: Column, end: Column) -> Column:
    """Month boundaries crossed between two dates (31 Jan to 1 Feb is 1)."""
    index = lambda day: F.year(day) * 12 + F.month(day)
    return (index(end) - index(start)).cast("bigint")


def surrogate_key(*parts: Column) -> Column:
    texts = [F.coalesce(part.cast("string"), F.lit(NULL_KEY_PART)) for part in parts]
    return F.md5(F.concat_ws("-", *texts))


def latest(value: Column, at: Column) -> Column:
    """Last non-NULL value in time. Of several at one instant, the greatest, so
    that the result is the same however rows arrive.

    One maximum over pairs carries the value once through the shuffle, where
    ``max_by`` would carry it twice: as the value and inside the order.
    """
    pair = F.struct(at.alias("at"), value.alias("value"))
    return F.max(F.when(value.isNotNull(), pair)).getField("value")


def hour_key(at: Column) -> Column:
    """``YYYY-MM-DD-H``: the hour is not padded in a file name."""
    return F.concat(F.date_format(at, "yyyy-MM-dd-"), F.hour(at).cast("string"))


def hour_path(at: Column) -> Column:
    """Landing path of an hourly file: the hour is padded in the folder only."""
    folder = F.date_format(at, "'year='yyyy'/month='MM'/day='dd'/hour='HH'/'")
    return F.concat(folder, hour_key(at), F.lit(".json.gz"))
