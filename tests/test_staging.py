import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark import tables, workspace
from tidemark.operators.dedup import first_seen, first_stored
from tidemark.operators.upsert import merge_into, merged
from tidemark.plans import staging

T = lambda text: dt.datetime.fromisoformat(text)


def event(number, at, repo=1, kind="PushEvent", **more):
    row = {"id": str(number), "type": kind, "actor": {"id": 1, "login": "a"}, "at": at,
           "payload": {}, **more}
    if repo is not None:
        row["repo"] = {"id": repo, "name": f"r{repo}"}
    return row


def stored(spark, path):
    df = staging.read_staged(spark, path)
    return sorted((r.event_id, str(r.created_at), str(r.date_day)) for r in df.collect())


def ids(spark, path):
    return {r.event_id: r.created_at for r in staging.read_staged(spark, path).collect()}


@pytest.fixture
def path(spark):
    return workspace.fresh_path(spark, "test-staged")


def test_json_fields_are_cast(raw):
    row = staging.stage_events(
        raw([{"id": "1", "type": "PushEvent", "actor": {"id": "12", "login": 5},
              "repo": {"id": 5.7, "name": "a/b"}, "payload": {"x": 1}, "at": "2024-01-01 01:00:00"}])
    ).first()
    assert (row.actor_id, row.actor_login, row.repo_id, row.repo_name) == (12, "5", 5, "a/b")
    too_big = staging.stage_events(
        raw([{"id": "1", "actor": {"id": 2**70}, "at": "2024-01-01 01:00:00"}])
    ).first()
    assert too_big.actor_id is None and too_big.repo_id is None


def test_schema_is_the_declared_one(raw):
    df = staging.stage_events(raw([event(1, "2024-01-01 00:00:00")]))
    assert [(f.name, f.dataType) for f in df.schema] == [
        (f.name, f.dataType) for f in staging.STAGED_SCHEMA
    ]


def test_first_copy_is_kept_and_null_time_comes_last(raw):
    rows = [event(1, "2024-01-01 02:00:00"), event(1, "2024-01-01 01:00:00"), event(1, None),
            event(2, None), event(None, "2024-01-01 02:00:00"), event(None, "2024-01-01 03:00:00")]
    rows[4]["id"] = rows[5]["id"] = None
    got = {r.event_id: r.created_at for r in staging.stage_events(raw(rows)).collect()}
    assert got == {"1": T("2024-01-01 01:00"), "2": None, None: T("2024-01-01 02:00")}


def test_copies_of_one_instant_are_settled_the_same_way(raw):
    rows = [event(1, "2024-01-01 01:00:00", repo=r, payload={"n": n})
            for r in (3, 2) for n in (1, 2, 3)]
    seen = set()
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        row = staging.stage_to_store(raw(rows).repartition(3)).select(
            "repo_id", F.to_json("payload").alias("p")
        ).first()
        seen.add(tuple(row))
    assert len(seen) == 1 and seen.pop()[0] == 2


def test_a_group_of_copies_holding_most_rows(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("event_id"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.expr("make_dt_interval(0, 0, 0, 30000 - id)")
         ).alias("created_at"),
    )
    kept = first_seen(df, tie_break=())
    assert kept.count() == 10_001
    hot = kept.where("event_id = 'hot'").first()
    assert hot.created_at == T("2024-01-01 00:00:01")


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_dedup_by_position_agrees_with_the_window(spark, raw, threshold):
    rng = random.Random(7)
    rows = []
    for i in range(300):
        number = rng.choice(["hot", None, str(rng.randint(1, 60)), str(i + 1000)])
        at = rng.choice([None, "2024-01-01 01:00:00", f"2024-01-01 0{rng.randint(0, 9)}:00:00"])
        rows.append({**event(0, at, repo=rng.randint(1, 3)), "id": number})
    stored_raw = workspace.pin(raw(rows + rows[:40]).repartition(3), "raw")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        events = staging.typed(stored_raw).drop("payload")
        bag = lambda df: Counter(tuple(r) for r in df.collect())
        assert bag(first_stored(events)) == bag(first_seen(events))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_require_repo(raw):
    rows = [event(1, "2024-01-01 01:00:00"), event(2, "2024-01-01 01:00:00", repo=None)]
    assert staging.stage_events(raw(rows)).count() == 2
    assert staging.stage_events(raw(rows), require_repo=True).count() == 1


def test_incremental_run_and_lateness(spark, raw, path):
    staging.incremental_run(raw([event("a", "2024-01-01 12:00:00")]), path)
    later = [
        event("on-time", "2024-01-01 13:00:00"),
        event("late-2h", "2024-01-01 10:00:00"),
        event("late-3h", "2024-01-01 09:00:00"),
        event("late-4h", "2024-01-01 08:00:00"),
    ]
    staging.incremental_run(raw(later), path)
    assert set(ids(spark, path)) == {"a", "on-time", "late-2h"}
    backfill = raw(later)
    staging.incremental_run(backfill, path, since=T("2024-01-01 07:00"), until=T("2024-01-01 07:59"))
    assert set(ids(spark, path)) == {"a", "on-time", "late-2h"}
    staging.incremental_run(backfill, path, since=T("2024-01-01 08:30"))
    assert set(ids(spark, path)) == {"a", "on-time", "late-2h", "late-3h"}


def test_lookback_frames(spark, raw):
    target = staging.stage_events(raw([event("a", "2024-01-01 12:00:00")]))
    new = raw([event("b", "2024-01-01 09:00:00"), event("c", "2024-01-01 09:00:01"),
               event("d", None)])
    assert [r.id for r in staging.within_lookback(new, target).collect()] == ["c"]
    assert [r.id for r in staging.too_late(new, target).collect()] == ["b"]
    empty = target.limit(0)
    assert staging.within_lookback(new, empty).count() == 3
    assert staging.too_late(new, empty).count() == 0


def test_an_empty_stored_table_is_filled(spark, raw, path):
    staging.write_staged(staging.stage_events(raw([])), path)
    staging.incremental_run(raw([event("a", "2024-01-01 12:00:00")]), path)
    assert set(ids(spark, path)) == {"a"}


def test_repeat_outside_the_lookback_replaces_the_first(spark, raw, path):
    first = [event("a", "2024-01-01 01:00:00"), event("z", "2024-01-01 09:00:00")]
    staging.incremental_run(raw(first), path)
    everything = raw([*first, event("a", "2024-01-01 08:00:00")])
    staging.incremental_run(everything, path)
    assert ids(spark, path)["a"] == T("2024-01-01 08:00")
    staging.full_refresh(everything, path)
    assert ids(spark, path)["a"] == T("2024-01-01 01:00")


def test_only_row_of_a_day_moves(spark, raw, path):
    staging.incremental_run(raw([event("a", "2024-01-01 23:00:00")]), path)
    staging.incremental_run(raw([event("a", "2024-01-02 01:00:00")]), path)
    assert stored(spark, path) == [("a", "2024-01-02 01:00:00", "2024-01-02")]
    assert tables.days(spark, path) == [dt.date(2024, 1, 2)]


def test_row_without_time_moves_to_a_day(spark, raw, path):
    staging.full_refresh(raw([event("a", None), event("b", "2024-01-01 23:00:00")]), path)
    assert tables.days(spark, path) == [None, dt.date(2024, 1, 1)]
    batch = workspace.pin(staging.stage_events(raw([event("a", "2024-01-01 22:00:00")])), "b")
    merge_into(batch, path)
    assert tables.days(spark, path) == [dt.date(2024, 1, 1)]
    assert set(ids(spark, path)) == {"a", "b"}


def test_null_ids_never_match(spark, raw, path):
    rows = [event(None, "2024-01-01 01:00:00")]
    rows[0]["id"] = None
    staging.full_refresh(raw(rows), path)
    batch = workspace.pin(staging.stage_events(raw(rows)), "b")
    merge_into(batch, path)
    assert staging.read_staged(spark, path).count() == 2


def test_empty_batch_changes_nothing(spark, raw, path):
    staging.full_refresh(raw([event("a", "2024-01-01 01:00:00")]), path)
    assert merge_into(workspace.pin(staging.stage_events(raw([])), "b"), path) == set()
    assert set(ids(spark, path)) == {"a"}


def test_only_touched_days_are_rewritten(spark, raw, path):
    staging.full_refresh(
        raw([event(i, f"2024-01-{i:02d} 01:00:00") for i in range(1, 6)]), path
    )
    files = lambda: {
        r[0] for r in staging.read_staged(spark, path).select("_metadata.file_path").collect()
    }
    before = files()
    batch = workspace.pin(staging.stage_events(raw([event(2, "2024-01-04 03:00:00")])), "b")
    assert merge_into(batch, path) == {dt.date(2024, 1, 2), dt.date(2024, 1, 4)}
    kept = before & files()
    assert {f.split("date_day=")[1][:10] for f in kept} == {"2024-01-01", "2024-01-03", "2024-01-05"}


def test_random_batches_match_a_dict(spark, raw, path):
    rng = random.Random(5)
    model = {}
    staging.write_staged(staging.stage_events(raw([])), path)
    for _ in range(4):
        batch = {str(rng.randint(1, 12)): f"2024-01-{rng.randint(1, 5):02d} 0{rng.randint(0, 9)}:00:00"
                 for _ in range(6)}
        rows = raw([event(i, at) for i, at in batch.items()])
        pinned = workspace.pin(staging.stage_events(rows), "b")
        for _ in range(2):  # the second time changes nothing
            merge_into(pinned, path)
            model.update(batch)
            got = staging.read_staged(spark, path).collect()
            assert Counter((r.event_id, str(r.created_at)) for r in got) == Counter(model.items())
            assert all(r.date_day == r.created_at.date() for r in got)
    frame = merged(staging.read_staged(spark, path).drop(tables.DAY), pinned)
    assert frame.count() == len(model)


def test_incremental_runs_equal_a_full_refresh(spark, raw, path):
    rows = [event(i, f"2024-01-01 {i:02d}:00:00") for i in range(20)]
    hours = [rows[:8], rows[8:15] + [event(3, "2024-01-01 07:30:00")][:0], rows[15:]]
    for i in range(len(hours)):
        staging.incremental_run(raw([r for part in hours[: i + 1] for r in part]), path)
    once = workspace.fresh_path(spark, "test-once")
    staging.full_refresh(raw(rows), once)
    assert stored(spark, path) == stored(spark, once)


def test_a_run_that_died_before_publishing_changes_nothing(spark, raw, path, monkeypatch):
    staging.full_refresh(raw([event("a", "2024-01-01 23:00:00"), event("b", "2024-01-03 01:00:00")]), path)
    before = stored(spark, path)
    reader = staging.read_staged(spark, path)
    batch = workspace.pin(staging.stage_events(raw([event("a", "2024-01-02 01:00:00")])), "b")
    with monkeypatch.context() as patch:
        patch.setattr(tables, "_publish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            merge_into(batch, path)
    assert stored(spark, path) == before
    merge_into(batch, path)
    assert stored(spark, path) == [
        ("a", "2024-01-02 01:00:00", "2024-01-02"), ("b", "2024-01-03 01:00:00", "2024-01-03")
    ]
    assert reader.count() == 2  # who read before still can
    tables.remove_old(spark, path, keep=1)
    assert len(stored(spark, path)) == 2
    assert len([n for n in tables.child_names(spark, path) if n.startswith("version=")]) == 2
    staging.full_refresh(raw([event("a", "2024-01-02 01:00:00")]), path)
    tables.remove_old(spark, path, keep=1)
    assert len([n for n in tables.child_names(spark, path) if n.startswith("version=")]) == 1
    assert len(tables.child_names(spark, f"{path}/{tables.MANIFESTS}")) == 1


def test_two_writers_do_not_overwrite_each_other(spark, raw, path):
    staging.full_refresh(raw([event("a", "2024-01-01 23:00:00")]), path)
    with pytest.raises(Exception):
        tables._publish(spark, path, 1, {})
    assert set(ids(spark, path)) == {"a"}
