import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark import workspace
from tidemark.plans import staging
from tidemark.sources import landing
from tidemark.streaming import changes


def event(number, at, repo=1):
    row = {"id": number, "type": "PushEvent", "actor": {"id": 1, "login": "a"}, "payload": {"x": 1},
           "at": at}
    if repo is not None:
        row["repo"] = {"id": repo, "name": f"r{repo}"}
    return row


BATCHES = [
    [event("a", "2024-01-01 01:00:00"), event("a", "2024-01-01 02:00:00"), event("b", "2024-01-01 23:00:00")],
    [event("c", "2024-01-02 01:00:00", repo=None), event("b", "2024-01-02 00:30:00")],
    [event("a", "2024-01-01 00:10:00"), event("d", "2024-01-02 05:00:00")],
]


@pytest.fixture
def append(spark, raw):
    """Append raw rows to a table in its stored form."""
    path = workspace.fresh_path(spark, "stream-raw")

    def go(rows):
        known = {f.name for f in landing.RAW_SCHEMA}
        extra = {
            f.name: F.lit(None).cast(f.dataType)
            for f in landing.STORED_SCHEMA if f.name not in known
        }
        at = {"load_status": F.lit("loaded"), "year": F.lit(2024), "month": F.lit(1),
              "day": F.lit(1), "hour": F.lit(0)}
        stored = raw(rows).withColumns({**extra, **at}).select(*landing.STORED_SCHEMA.names)
        stored.coalesce(1).write.mode("append").partitionBy(
            "load_status", *landing.HOUR_COLUMNS).parquet(path)

    go.path = path
    return go


def state(spark, path):
    return {r.event_id: r.created_at for r in staging.read_staged(spark, path).collect()}


def follow(spark, append, path, **options):
    query = changes.follow_raw(spark, append.path, path, path + "-checkpoint", **options)
    query.awaitTermination()
    return query


def test_stream_equals_the_batches_applied_one_by_one(spark, raw, append):
    path, model = workspace.fresh_path(spark, "streamed"), workspace.fresh_path(spark, "batched")
    for rows in BATCHES:
        append(rows)
        follow(spark, append, path)
        changes.apply_changes(raw(rows), model)
    T = dt.datetime.fromisoformat
    assert state(spark, path) == state(spark, model) == {
        "a": T("2024-01-01 00:10"), "b": T("2024-01-02 00:30"), "d": T("2024-01-02 05:00"),
    }


def test_nothing_new_runs_no_batch(spark, append):
    path = workspace.fresh_path(spark, "streamed")
    append(BATCHES[0])
    assert follow(spark, append, path).lastProgress is not None
    before = state(spark, path)
    idle = follow(spark, append, path)
    assert not [p for p in idle.recentProgress if p.numInputRows > 0]
    assert state(spark, path) == before


def test_exact_lateness_in_the_stream(spark, append):
    path = workspace.fresh_path(spark, "streamed")
    append([event("a", "2024-01-01 12:00:00")])
    follow(spark, append, path, lookback_hours=3)
    append([event("3h", "2024-01-01 09:00:00"), event("2h", "2024-01-01 10:00:00")])
    follow(spark, append, path, lookback_hours=3)
    assert set(state(spark, path)) == {"a", "2h"}


def test_replayed_batch_changes_nothing(spark, raw):
    path = workspace.fresh_path(spark, "replayed")
    for rows in BATCHES:
        changes.apply_changes(raw(rows), path)
    before = state(spark, path)
    changes.apply_changes(raw(BATCHES[-1]), path)
    assert state(spark, path) == before


def test_watermark_dedup(spark, append):
    def go(position):
        stream = staging.typed(changes.raw_changes(spark, append.path))
        query = (
            changes.drop_repeats(stream).select("event_id").writeStream.format("parquet")
            .option("checkpointLocation", position + "-checkpoint").option("path", position)
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return sorted(r.event_id for r in spark.read.parquet(position).collect())

    position = workspace.fresh_path(spark, "once")
    hot = [event("hot", "2024-01-01 12:00:00") for _ in range(500)]
    append(hot + [event("a", "2024-01-01 12:30:00")])
    assert go(position) == ["a", "hot"]
    append([event("hot", "2024-01-01 12:00:00"), event("b", "2024-01-01 13:00:00")])
    assert go(position) == ["a", "b", "hot"]
