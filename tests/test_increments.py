import datetime as dt
import random

import pytest
from compare import spark_bag
from pyspark.sql import functions as F

from tidemark import tables, workspace
from tidemark.operators import keyindex, ranking, upsert
from tidemark.plans import build, checks, increments, marts, staging

KINDS = ["WatchEvent", "ForkEvent", "PushEvent", "IssuesEvent", "GollumEvent", None]
FIELDS = (
    "event_id string, event_type string, actor_id long, actor_login string, repo_id long, repo_name string, "
    "payload string, created_at string"
)


def day(n):
    return dt.date(2024, 1, 28) + dt.timedelta(days=n)


def staged(spark, rows):
    """Rows of (id, type, actor, repo, day, hour), labels on every third id."""
    full = [
        (str(i), kind, actor, actor and f"u{actor}", repo, repo and f"r{repo}",
         '{"action":"labeled","labels":[{"name":"x%d"}]}' % (int(i) % 4), at and f"{at} {hour:02d}:00:00")
        for i, kind, actor, repo, at, hour in rows
    ]
    df = spark.createDataFrame(full, FIELDS)
    return df.withColumns({"payload": F.parse_json("payload"), "created_at": F.col("created_at").cast("timestamp_ntz")})


def put(spark, path, rows, days=None):
    df = staged(spark, rows).withColumn(tables.DAY, F.to_date("created_at"))
    tables.write_by_day(df, path, "event_id", replace=days)


def same_marts(spark, layout):
    events = workspace.pin(staging.read_staged(spark, layout.staged), "events")
    made = {
        "trending_repos": marts.trending_repos,
        "contributor_retention": marts.contributor_retention,
        "category_trends": marts.category_trends,
        "label_usage": marts.label_usage,
    }
    for name, mart in made.items():
        assert spark_bag(build.read_mart(spark, layout, name)) == spark_bag(mart(events)), name


def some(rng, n, days):
    kind = lambda: rng.choice([*KINDS, "PullRequestEvent"])
    return [
        (i, kind(), rng.choice([None, 1, 2, 3, 4, 5, 6]), rng.choice([None, *range(1, 12)]), rng.choice(days), rng.randint(0, 23))
        for i in rng.sample(range(10_000), n)
    ]


def test_reached_rows_equal_their_definition(spark):
    rng = random.Random(1)
    rows = {(k, day(n)) for k in range(6) for n in range(40) if rng.random() < 0.4} | {(None, day(3)), (None, None), (2, None)}
    changed = {(rng.choice([None, *range(7)]), rng.choice([None, *map(day, range(40))])) for _ in range(9)}
    at = lambda d: (d is None, d or dt.date.max)
    expected = set()
    for key, own in rows:
        for other, d in changed:
            between = [x for k, x in rows if k == key and at(d) < at(x) <= at(own)]
            if key == other and at(d) <= at(own) and len(between) < 7:
                expected.add((key, own))
    frame = lambda pairs: spark.createDataFrame(sorted(pairs, key=str), "repo_id long, date_day date")
    got = ranking.reached_rows(frame(rows), frame(changed))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, expected))


def test_changed_days_give_the_marts_of_a_full_rebuild(spark, tmp_path):
    """Days are changed, emptied and added, early ones and late ones, and one without a date."""
    rng = random.Random(2)
    layout = build.Layout(str(tmp_path))
    put(spark, layout.staged, some(rng, 150, [*map(day, range(0, 40, 2)), None]))
    build.build_marts(spark, layout)
    same_marts(spark, layout)
    for days, rows in (
        ([day(6), day(7), None], some(rng, 12, [day(6), None])),
        ([day(0), day(20), day(41)], some(rng, 20, [day(41), day(20)])),
    ):
        put(spark, layout.staged, rows, days)
        build.build_marts(spark, layout)
        same_marts(spark, layout)


def test_only_reached_days_are_written(spark, tmp_path):
    layout = build.Layout(str(tmp_path))
    rows = [(n, "WatchEvent", 1, 1, day(n), 1) for n in range(20)] + [(100 + n, "WatchEvent", 1, 2, day(n), 1) for n in range(20)]
    put(spark, layout.staged, rows)
    build.build_marts(spark, layout)
    path = layout.mart("trending_repos")
    before = tables.versions(spark, path)
    put(spark, layout.staged, [(3, "WatchEvent", 1, 1, day(3), 1), (50, "WatchEvent", 1, 1, day(3), 1)], [day(3)])
    build.build_marts(spark, layout)
    after = tables.versions(spark, path)
    assert {d for d in after if after[d] != before[d]} == {day(n) for n in range(3, 10)}
    same_marts(spark, layout)


@pytest.mark.parametrize("step", ["update_cells", "publish_snapshot"])
def test_a_run_that_dies_between_marts_shows_the_old_ones(spark, tmp_path, monkeypatch, step):
    rng = random.Random(3)
    layout = build.Layout(str(tmp_path))
    put(spark, layout.staged, some(rng, 60, [*map(day, range(12))]))
    with pytest.raises(LookupError):
        build.read_mart(spark, layout, "label_usage")
    build.build_marts(spark, layout)
    old = {name: spark_bag(build.read_mart(spark, layout, name)) for name in build.MARTS}
    put(spark, layout.staged, some(rng, 30, [day(2), day(5)]), [day(2), day(5)])
    with monkeypatch.context() as patch:
        patch.setattr(increments, step, lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            build.build_marts(spark, layout)
    assert {name: spark_bag(build.read_mart(spark, layout, name)) for name in build.MARTS} == old
    build.build_marts(spark, layout)
    same_marts(spark, layout)


def test_first_months_are_found_again_after_a_run_that_died(spark, tmp_path, monkeypatch):
    """The first months are published, and the run dies before the counts of the months that they move are."""
    layout = build.Layout(str(tmp_path))
    rows = [(1, "PushEvent", 7, 1, day(0), 1), (2, "PushEvent", 7, 1, day(10), 1), (3, "PushEvent", 8, 1, day(40), 1)]
    put(spark, layout.staged, rows)
    build.build_marts(spark, layout)
    put(spark, layout.staged, [(1, "PushEvent", 9, 1, day(0), 1)], [day(0)])
    write = tables.write_by_day
    with monkeypatch.context() as patch:
        patch.setattr(tables, "write_by_day", lambda df, path, *a, **k: 1 / 0 if path.endswith("retention_cells") else write(df, path, *a, **k))
        with pytest.raises(ZeroDivisionError):
            build.build_marts(spark, layout)
    build.build_marts(spark, layout)
    same_marts(spark, layout)
    got = {tuple(r)[:2] for r in build.read_mart(spark, layout, "contributor_retention").collect()}
    assert (dt.date(2024, 2, 1), dt.date(2024, 2, 1)) in got and (dt.date(2024, 1, 1), dt.date(2024, 2, 1)) not in got


def forget(spark, path, days):
    """Delete the files of some days, so that whoever reads them fails."""
    for d, version in tables.versions(spark, path).items():
        if d in days:
            tables.delete(spark, f"{path}/{version}/{tables.DAY}={d}")


def test_checks_read_the_changed_days_only(spark, tmp_path):
    layout = build.Layout(str(tmp_path))
    rows = [(n, "PushEvent", n % 5, n % 7, day(n % 20), 1) for n in range(100)]
    put(spark, layout.staged, rows + [(0, "OddEvent", 1, 1, day(4), 2), (200, "OddEvent", None, None, day(4), 3)])
    build.build_marts(spark, layout)
    status = lambda: {(r.model, r.check, r.column): r.failures for r in build.check_all(spark, layout).collect()}
    first = status()
    assert first["staged_events", "unique", "event_id"] == 1
    assert first["staged_events", "accepted_values", "event_type"] == 1
    assert first["developer_activity", "not_null", "actor_id"] == 1
    put(spark, layout.staged, [(301, None, 1, 1, day(2), 1), (301, "PushEvent", 1, 1, day(2), 2), (19, "OddEvent", 1, 1, day(2), 2)], [day(2)])
    build.update_day_tables(spark, layout)
    old = [day(n) for n in range(20) if n not in (2, 19)]
    for path in (layout.staged, *[layout.day_table(n) for n in build.DAY_TABLES]):
        forget(spark, path, old)
    later = status()
    assert later["staged_events", "unique", "event_id"] == 3  # 0 on two days, 301 twice, 19 on two days
    assert later["staged_events", "accepted_values", "event_type"] == 1
    assert later["staged_events", "not_null", "event_type"] == 1
    assert status() == later


def test_a_key_that_leaves_one_of_its_days_is_no_repeat(spark, tmp_path):
    path, state = f"{tmp_path}/staged", f"{tmp_path}/checked"
    models = {"staged_events": lambda only: staging.read_staged(spark, path, only)}

    def failures():
        checks.update(spark, state, path, staging.STAGED_SCHEMA, models)
        report = checks.report(spark, state, path, models)
        return report.where("check = 'unique'").first().failures

    put(spark, path, [(1, "PushEvent", 1, 1, day(0), 1), (2, "PushEvent", 1, 1, day(0), 1), (1, "PushEvent", 1, 1, day(1), 1)])
    assert failures() == 1
    put(spark, path, [(3, "PushEvent", 1, 1, day(1), 1)], [day(1)])
    assert failures() == 0
    put(spark, path, [(2, "PushEvent", 1, 1, day(1), 1)], [day(1)])
    assert failures() == 1
    put(spark, path, [(5, "PushEvent", 1, 1, day(0), 1)], [day(0)])
    assert failures() == 0


def test_key_index_names_every_day_and_no_file_of_others_is_read(spark, tmp_path):
    path = f"{tmp_path}/staged"
    rng = random.Random(4)
    ids = rng.sample(range(10**9), 60)
    rows = [(x, "PushEvent", 1, 1, day(i % 20), 1) for i, x in enumerate(ids)]
    put(spark, path, rows)
    schema = staging.STAGED_SCHEMA
    keyindex.update(spark, path, schema, "event_id")
    keys = spark.createDataFrame([(str(ids[3]),), (str(ids[23]),), ("none",), (None,)], "event_id string")
    found = {tuple(r) for r in keyindex.candidates(keys, path, "event_id").collect()}
    assert found == {(str(ids[3]), day(3)), (str(ids[23]), day(3))}
    forget(spark, path, [day(n) for n in range(20) if n not in (3, 4)])
    batch = staged(spark, [(ids[3], "ForkEvent", 2, 2, day(4), 5), (ids[23], "ForkEvent", 2, 2, day(30), 5), (7, "ForkEvent", 2, 2, day(30), 6)])
    touched = upsert.merge_into(workspace.pin(batch, "batch"), path)
    assert touched == {day(3), day(4), day(30)}
    left = staging.read_staged(spark, path, touched)
    assert {(r.event_id, r.date_day) for r in left.where("event_type = 'ForkEvent'").collect()} == {
        (str(ids[3]), day(4)), (str(ids[23]), day(30)), ("7", day(30)),
    }
    assert left.where(F.col("event_type") == "PushEvent").count() == 4
    # The moved key's old day is still named, and harmless.
    assert found - {tuple(r) for r in keyindex.candidates(keys, path, "event_id").collect()} == set()


def test_fold_forgets_what_has_moved(spark, tmp_path):
    path = f"{tmp_path}/staged"
    put(spark, path, [(1, "PushEvent", 1, 1, day(0), 1), (2, "PushEvent", 1, 1, day(1), 1)])
    upsert.merge_into(workspace.pin(staged(spark, [(1, "PushEvent", 1, 1, day(1), 1)]), "batch"), path)
    pairs = lambda: sorted(tuple(r) for r in keyindex.read(spark, path).join(
        spark.createDataFrame([("1",), ("2",)], "event_id string").withColumn("key_hash", F.xxhash64("event_id")), "key_hash"
    ).select("event_id", tables.DAY).distinct().collect())
    assert pairs() == [("1", day(0)), ("1", day(1)), ("2", day(1))]
    keyindex.fold(spark, path, staging.STAGED_SCHEMA, "event_id")
    assert pairs() == [("1", day(1)), ("2", day(1))]
    # A fold that died is passed over.
    tables.publish_names(spark, f"{keyindex.index_path(path)}/generation=9", {})
    assert pairs() == [("1", day(1)), ("2", day(1))]
    upsert.merge_into(workspace.pin(staged(spark, [(2, "PushEvent", 1, 1, day(5), 1)]), "batch"), path)
    assert ("2", day(5)) in pairs()
