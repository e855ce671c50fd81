import datetime as dt

import pytest
from compare import spark_bag
from pyspark.sql import functions as F

from tidemark import tables, workspace
from tidemark.plans import build, catalog, marts, serving, staging
from tidemark.sources import landing, shapes

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def places(spark, tmp_path):
    events = catalog.table(spark, FOLDER, "events").where("ts < '2024-01-02'")
    root = str(tmp_path / "landing")
    shapes.write_landing(shapes.lines_from_events(events), root)
    return root, build.Layout(str(tmp_path / "tables"))


def test_two_runs_equal_marts_over_all_raw_events(spark, places):
    root, layout = places
    first, last = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2, 23)
    noon = dt.datetime(2024, 1, 1, 12)
    build.run(spark, root, layout, first, noon)
    build.run(spark, root, layout, noon, last)
    staged = staging.stage_events(landing.raw_events(spark, layout.raw, layout.ledger))
    stored = staging.read_staged(spark, layout.staged)
    assert stored.count() == staged.count()
    assert stored.select("event_id").distinct().count() == stored.count()
    over_events = {
        "trending_repos": marts.trending_repos,
        "contributor_retention": marts.contributor_retention,
        "category_trends": marts.category_trends,
        "label_usage": marts.label_usage,
    }
    for name, mart in over_events.items():
        assert spark_bag(build.read_mart(spark, layout, name)) == spark_bag(mart(stored)), name
    for name, (table, _) in build.DAY_TABLES.items():
        found, made = build.read_day_table(spark, layout, name), table(stored)
        assert spark_bag(found) == spark_bag(made.select(*found.columns)), name
    build.run(spark, root, layout, first, last)
    assert staging.read_staged(spark, layout.staged).count() == staged.count()


def test_backfill_reaches_behind_the_lookback(spark, places):
    root, layout = places
    empty = dt.datetime(2024, 1, 5)
    build.require_passed(build.run(spark, root, layout, empty, empty))
    assert build.read_mart(spark, layout, "trending_repos").count() == 0
    evening = dt.datetime(2024, 1, 1, 20)
    build.run(spark, root, layout, evening, evening)
    newest = staging.read_staged(spark, layout.staged).count()
    missing = build.backfill(spark, root, layout, dt.date(2024, 1, 1), dt.date(2024, 1, 2))
    landed = landing.loaded_hours(landing.list_files(spark, root)).count()
    assert missing.count() == 48 - landed
    assert {f"2024-01-02-{h}" for h in range(1, 24)} <= {r.hour_key for r in missing.collect()}
    stored = staging.read_staged(spark, layout.staged)
    staged = staging.stage_events(landing.raw_events(spark, layout.raw, layout.ledger))
    assert stored.count() == staged.count() > newest
    assert build.read_mart(spark, layout, "trending_repos").select("date_day").distinct().count() == 1


def test_report_of_a_run(spark, places):
    """Repeats in the raw table are reported but do not stop the job; an event
    without a repo that reaches the ranking does."""
    root, layout = places
    last = dt.datetime(2024, 1, 2, 23)
    report = build.run(spark, root, layout, dt.datetime(2024, 1, 1), last, check_raw=True, as_of=dt.datetime(2024, 1, 1, 23))
    status = {(r.model, r.check, r.column): r.status for r in report.collect()}
    assert len(status) == 25
    assert {k for k, v in status.items() if v == "fail"} == {
        ("raw_events", "unique", "id"),
        ("trending_repos", "not_null", "repo_id"),
        ("trending_repos", "not_null", "repo_name"),
    }
    assert status["raw_events", "freshness", "created_at"] == "pass"
    late = build.check_all(spark, layout).where("check = 'freshness'").first()
    assert (late.status, late.failures) == ("fail", 1)
    assert build.check_all(spark, layout).where("model = 'raw_events'").count() == 1
    assert status["repo_daily_stats", "not_null", "repo_id"] == "warn"
    with pytest.raises(build.ChecksFailed) as caught:
        build.require_passed(report)
    assert {r.model for r in caught.value.args[0]} == {"trending_repos"}
    build.require_passed(report.where("model <> 'trending_repos'"))


def test_scoped_pins_are_deleted(spark):
    df = spark.range(3)
    with workspace.scoped(spark):
        inner = workspace.fresh_path(spark, "x")
        df.write.parquet(inner)
        assert tables.exists(spark, inner)
    assert not tables.exists(spark, inner)
    assert "/session/" in workspace.fresh_path(spark, "y")


def test_tables_answer_sql(spark, places):
    root, layout = places
    build.run(spark, root, layout, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2, 23))
    trending = build.read_mart(spark, layout, "trending_repos")
    serving.append_insight(trending, layout.insights, "text", "model", dt.datetime(2024, 1, 4))
    build.register_views(spark, layout)
    top = spark.sql(
        """SELECT repo_name, trending_rank FROM trending_repos
           WHERE date_day = (SELECT MAX(date_day) FROM trending_repos) AND trending_rank <= 10
           ORDER BY trending_rank"""
    )
    assert spark_bag(top) == spark_bag(
        serving.feed_trending(trending).select("repo_name", "trending_rank")
    )
    week = spark.sql(
        """SELECT date_day, event_category, event_count, wow_growth_rate FROM category_trends
           WHERE date_day >= DATEADD(DAY, -7, (SELECT MAX(date_day) FROM category_trends))"""
    )
    trends = build.read_mart(spark, layout, "category_trends")
    assert spark_bag(week) == spark_bag(serving.feed_trends(trends))
    assert spark.sql("SELECT insight_text FROM daily_insights").first()[0] == "text"
    assert spark.sql("SELECT MAX(created_at) FROM staged_events").first()[0].day == 1
    shown = [
        (r.date_day, r.event_count) for r in serving.in_order(trends, "category_trends").collect()
    ]
    assert shown == sorted(shown, reverse=True)


def test_late_events_in_the_first_files_of_a_backfill(spark, tmp_path):
    from test_landing import land, line

    root, layout = str(tmp_path / "landing"), build.Layout(str(tmp_path / "tables"))
    land(root, "2024-01-05T10", [line(id="new", created_at="2024-01-05T10:00:00Z")])
    at = dt.datetime(2024, 1, 5, 10)
    build.run(spark, root, layout, at, at)
    land(root, "2024-01-02T00", [line(id="late", created_at="2024-01-01T23:30:00Z"),
                                 line(id="in", created_at="2024-01-02T00:10:00Z")])
    build.backfill(spark, root, layout, dt.date(2024, 1, 2), dt.date(2024, 1, 2))
    assert {r.event_id for r in staging.read_staged(spark, layout.staged).collect()} == {"new", "late", "in"}
    days = {str(r.date_day) for r in build.read_day_table(spark, layout, "category_daily").collect()}
    assert days == {"2024-01-01", "2024-01-02", "2024-01-05"}


def test_only_touched_days_are_made_again(spark, places):
    root, layout = places
    first, last = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2, 23)
    build.run(spark, root, layout, first, last)
    assert build.stale_days(spark, layout) == set()
    before = tables.versions(spark, layout.day_table("repo_daily_stats"))
    batch = spark.createDataFrame([("x", "2024-01-07T01:00:00")], "id string, at string").selectExpr(
        "id", "'PushEvent' AS type", "parse_json('{\"id\":1}') AS actor", "parse_json('{\"id\":1,\"name\":\"n\"}') AS repo",
        "parse_json('{}') AS payload", "cast(at as timestamp_ntz) AS created_at")
    staging.upsert_raw(batch, layout.staged)
    assert build.stale_days(spark, layout) == {dt.date(2024, 1, 7)}
    assert build.update_day_tables(spark, layout) == {dt.date(2024, 1, 7)}
    after = tables.versions(spark, layout.day_table("repo_daily_stats"))
    assert {d for d in after if before.get(d) != after[d]} == {dt.date(2024, 1, 7)}
    assert all("date_day=2024-01-07" in f for f in
               staging.read_staged(spark, layout.staged, [dt.date(2024, 1, 7)]).inputFiles())


def test_a_run_that_died_between_staging_and_the_day_tables(spark, places, monkeypatch):
    root, layout = places
    first, last = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2, 23)
    with monkeypatch.context() as patch:
        patch.setattr(tables, "publish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            build.run(spark, root, layout, first, last)
    build.run(spark, root, layout, first, last)
    stored = staging.read_staged(spark, layout.staged)
    assert spark_bag(build.read_mart(spark, layout, "category_trends")) == spark_bag(marts.category_trends(stored))


def test_staging_reads_only_the_hours_that_may_reach_behind_the_bound(spark, tmp_path):
    from test_landing import land, line

    root, layout = str(tmp_path / "landing"), build.Layout(str(tmp_path / "tables"))
    for hour in range(0, 20):
        land(root, f"2024-01-01T{hour:02d}", [line(id=str(hour), created_at=f"2024-01-01T{hour:02d}:30:00Z")])
    # An event of the evening in a file of the morning.
    land(root, "2024-01-01T03", [line(id="odd", created_at="2024-01-01T19:10:00Z")])
    landing.load_hours(spark, root, layout.raw, layout.ledger)
    bound = dt.datetime(2024, 1, 1, 17)
    raw = build.raw_behind(spark, layout, bound)
    assert {r.id for r in raw.collect()} == {"odd", "17", "18", "19"}
    files = {f.split("hour=")[1][:2].strip("/") for f in raw.select("_metadata.file_path").toPandas().file_path}
    assert files == {"3", "17", "18", "19"}


def listed(spark):
    """Files that Spark has found by listing folders so far."""
    return spark._jvm.org.apache.spark.metrics.source.HiveCatalogMetrics.METRIC_FILES_DISCOVERED().getCount()


def test_a_run_lists_only_the_folders_of_its_hours(spark, tmp_path):
    """Ten thousand old hours are loaded; the next hour's run opens none of them."""
    import shutil

    from test_landing import land, line

    root, layout = str(tmp_path / "landing"), build.Layout(str(tmp_path / "tables"))
    first, old = dt.datetime(2024, 1, 1), 10_000
    land(root, first.isoformat(), [line(id="0", created_at=first.isoformat())])
    landing.load_hours(spark, root, layout.raw, layout.ledger)
    entry = landing.read_ledger(spark, layout.ledger).drop("source_file", "last_created_at", tables.DAY)
    [source] = landing.loaded_folders(spark, layout.raw, layout.ledger)
    hours = [first - dt.timedelta(hours=h) for h in range(1, old + 1)]
    load = source.split("/load_status")[0]
    for hour in hours:
        shutil.copytree(source.removeprefix("file:"), f"{load}/load_status=loaded/{landing.stored_folder(hour)}".removeprefix("file:"))
    paths = [(f"{landing.hour_folder(h)}/{h:%Y-%m-%d}-{h.hour}.json.gz", h) for h in hours]
    entries = entry.crossJoin(spark.createDataFrame(paths, "source_file string, last_created_at timestamp_ntz"))
    entries = entries.withColumn(tables.DAY, F.to_date("last_created_at")).select(*landing.LEDGER_SCHEMA.names)
    landing.publish_load(workspace.pin(entries, "entries"), layout.ledger)
    assert len(landing.loaded_folders(spark, layout.raw, layout.ledger)) == old + 1
    staging.write_staged(staging.stage_events(landing.raw_of(spark, layout.raw, [source])), layout.staged)
    build.build_marts(spark, layout)

    following = first + dt.timedelta(hours=1)
    land(root, following.isoformat(), [line(id="1", created_at=following.isoformat())])
    before = listed(spark)
    build.run(spark, root, layout, following, following)
    assert listed(spark) - before < 400
    assert staging.read_staged(spark, layout.staged).count() == 2
    before = listed(spark)
    assert landing.raw_events(spark, layout.raw, layout.ledger).count() > old
    assert listed(spark) - before > old
