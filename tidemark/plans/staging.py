"""Raw events to the staged table: one typed row per event id."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark import tables, workspace
from tidemark.functions.expressions import day_of, instant
from tidemark.operators.dedup import TIE_BREAK, first_seen, first_stored
from tidemark.operators.ranking import newest
from tidemark.operators.upsert import merge_into

LOOKBACK_HOURS = 3
LINE_HASH = "line_hash"

STAGED_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("actor_id", T.LongType()),
        T.StructField("actor_login", T.StringType()),
        T.StructField("repo_id", T.LongType()),
        T.StructField("repo_name", T.StringType()),
        T.StructField("payload", T.VariantType()),
        T.StructField("created_at", T.TimestampNTZType()),
    ]
)


def typed(raw: DataFrame, require_repo: bool = False) -> DataFrame:
    """Raw columns renamed, and the used JSON fields cast to columns.

    The hash of the line stays where the raw rows have one.
    """
    events = raw.select(
        F.col("id").alias("event_id"),
        F.col("type").alias("event_type"),
        F.try_variant_get("actor", "$.id", "bigint").alias("actor_id"),
        F.try_variant_get("actor", "$.login", "string").alias("actor_login"),
        F.try_variant_get("repo", "$.id", "bigint").alias("repo_id"),
        F.try_variant_get("repo", "$.name", "string").alias("repo_name"),
        "payload",
        "created_at",
        *[c for c in raw.columns if c == LINE_HASH],
    )
    return events.where(F.col("repo_id").isNotNull()) if require_repo else events


def copies_by(raw: DataFrame) -> tuple[str, ...]:
    """The columns that settle between copies of one instant; last the hash of the line, where there is one."""
    return (*TIE_BREAK, LINE_HASH) if LINE_HASH in raw.columns else TIE_BREAK


def stage_events(
    raw: DataFrame,
    require_repo: bool = False,
    tie_break: tuple[str | Column, ...] | None = None,
) -> DataFrame:
    """Typed events, the earliest copy of each id. ``require_repo`` drops events
    without a repo id, as the change stream does and the batch run does not."""
    tie_break = copies_by(raw) if tie_break is None else tie_break
    return first_seen(typed(raw, require_repo), tie_break=tie_break).drop(LINE_HASH)


def stage_to_store(raw: DataFrame, require_repo: bool = False) -> DataFrame:
    """As ``stage_events``; copies that differ in the payload only are told
    apart also where no hash of the line was stored."""
    by = copies_by(raw)
    if LINE_HASH not in by:
        return stage_events(raw, require_repo, (*by, F.xxhash64(F.to_json("payload"))))
    return stage_events(raw, require_repo, by)


def within_lookback(raw: DataFrame, target: DataFrame, hours: int = LOOKBACK_HOURS) -> DataFrame:
    """Raw events later than ``hours`` before the newest staged one.

    An empty target accepts everything.
    """
    bound = newest(target, "created_at") - F.expr(f"INTERVAL {int(hours)} HOURS")
    return raw.where((F.col("created_at") > bound) | bound.isNull())


def too_late(raw: DataFrame, target: DataFrame, hours: int = LOOKBACK_HOURS) -> DataFrame:
    """The complement: events that an incremental run does not stage."""
    bound = newest(target, "created_at") - F.expr(f"INTERVAL {int(hours)} HOURS")
    return raw.where(F.col("created_at") <= bound)


def incremental_batch(raw: DataFrame, target: DataFrame, hours: int = LOOKBACK_HOURS) -> DataFrame:
    """The staged rows that one incremental run upserts into ``target``."""
    return stage_events(within_lookback(raw, target, hours))


def write_staged(staged: DataFrame, path: str) -> None:
    """Replace the staged table."""
    by_day = staged.withColumn(tables.DAY, day_of(F.col("created_at")))
    tables.write_by_day(by_day, path, "event_id")


def full_refresh(raw: DataFrame, path: str, stored: bool = False) -> None:
    """Stage every raw event and replace the table.

    ``stored`` says that ``raw`` gives the rows of Parquet files one to one, as
    the raw table does; copies are then found without shuffling payloads.
    """
    if not stored:
        write_staged(stage_to_store(raw), path)
        return
    with workspace.scoped(raw.sparkSession):
        write_staged(first_stored(typed(raw), tie_break=copies_by(raw)).drop(LINE_HASH), path)


def reach_back(
    spark: SparkSession, path: str, hours: int = LOOKBACK_HOURS, since: datetime | None = None
) -> datetime | None:
    """The instant after which an incremental run stages; None where nothing is staged yet.

    ``since`` reaches back further. Read from the last day folder.
    """
    newest_staged = tables.newest_instant(spark, path, STAGED_SCHEMA, "created_at")
    if newest_staged is None:
        return None
    return since if since is not None else newest_staged - timedelta(hours=hours)


def upsert_raw(raw: DataFrame, path: str) -> set[date | None]:
    """Stage all of ``raw`` and upsert it; returns the rewritten days."""
    with workspace.scoped(raw.sparkSession):
        return merge_into(workspace.pin(stage_to_store(raw), "batch"), path)


def incremental_run(
    raw: DataFrame,
    path: str,
    hours: int = LOOKBACK_HOURS,
    since: datetime | None = None,
    until: datetime | None = None,
    stored: bool = False,
) -> set[date | None] | None:
    """Stage what is new and upsert it; without a table, a full refresh.

    Events at or before ``newest - hours`` are not staged, backfilled history
    included: pass ``since`` to reach back, and ``until`` to stop there. The bound
    becomes a literal that the raw scan can skip row groups by. ``stored`` is as for the full refresh.
    Returns the rewritten days, or None after a full refresh.
    """
    bound = reach_back(raw.sparkSession, path, hours, since)
    if bound is None:
        full_refresh(raw, path, stored)
        return None
    recent = raw.where(F.col("created_at") > instant(bound))
    if until is not None:
        recent = recent.where(F.col("created_at") <= instant(until))
    return upsert_raw(recent, path)


def read_staged(
    spark: SparkSession, path: str, only: Iterable[date | None] | None = None
) -> DataFrame:
    """The staged table, or some of its days."""
    return tables.read_by_day(spark, path, STAGED_SCHEMA, only)
