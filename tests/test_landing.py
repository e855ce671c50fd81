import datetime as dt
import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from tidemark import workspace
from tidemark.sources import hours, landing

GOOD = {"id": "1", "type": "PushEvent", "actor": {"id": 1, "login": "é"}, "repo": {"id": 2, "name": "a/b"},
        "payload": {"x": [1]}, "created_at": "2024-01-01T05:00:00Z"}


def line(**changes):
    return json.dumps({**GOOD, **changes}).encode()


def land(root, hour, lines):
    at = dt.datetime.fromisoformat(hour)
    folder = f"{root}/year={at:%Y}/month={at:%m}/day={at:%d}/hour={at:%H}"
    os.makedirs(folder, exist_ok=True)
    with gzip.open(f"{folder}/{at:%Y-%m-%d}-{at.hour}.json.gz", "wb") as f:
        f.write(b"\n".join(lines) + (b"\n" if lines else b""))


@pytest.fixture
def places(spark, tmp_path):
    return str(tmp_path / "raw"), workspace.fresh_path(spark, "raw"), workspace.fresh_path(spark, "ledger")


def report(df):
    return {r.source_file.split("/")[-1]: (r.rows_loaded, r.errors_seen, r.status) for r in df.collect()}


def test_tolerant_scan(spark, places):
    root, raw_path, ledger = places
    bad_utf8 = line(id="bad-utf8").replace(b'"\\u00e9"', b'"l\xffgin"')
    no_repo = {k: v for k, v in GOOD.items() if k != "repo"}
    land(root, "2024-01-01T05", [
        line(),
        json.dumps({**no_repo, "id": "no-repo"}).encode(),
        b"{bad json",
        line(id="no-time", created_at="notatime"),
        bad_utf8,
        b"",
        b"  ",
        line(id="offset", created_at="2024-01-01T05:00:00+03:00"),
        line(id=77, created_at=None),
        b'{"id": "twice", "id": "keys"}',
        line(id="crlf") + b"\r",
    ])
    got = landing.load_hours(spark, root, raw_path, ledger)
    assert report(got) == {"2024-01-01-5.json.gz": (6, 3, "SUCCESS")}
    rows = {r.id: r for r in landing.raw_events(spark, raw_path, ledger).withColumn(
        "login", F.try_variant_get("actor", "$.login", "string")).collect()}
    assert set(rows) == {"1", "no-repo", "bad-utf8", "offset", "77", "crlf"}
    assert rows["1"].login == "é" and rows["bad-utf8"].login == "l�gin"
    assert rows["no-repo"].repo is None and rows["77"].created_at is None
    five = dt.datetime(2024, 1, 1, 5)
    assert rows["1"].created_at == rows["offset"].created_at == five
    bad = {(r.bad_reason, r.bad_line[:9]) for r in landing.rejected_lines(spark, raw_path, ledger).collect()}
    assert bad == {("not JSON", "{bad json"), ("not a time", '{"id": "n'), ("not JSON", '{"id": "t')}


def test_a_line_that_is_no_object_loads_as_nulls(spark, places):
    root, raw_path, ledger = places
    land(root, "2024-01-01T05", [b"5", b"null", b"[1]"])
    got = landing.load_hours(spark, root, raw_path, ledger)
    assert report(got) == {"2024-01-01-5.json.gz": (3, 0, "SUCCESS")}
    assert {tuple(r)[:6] for r in landing.raw_events(spark, raw_path, ledger).collect()} == {(None,) * 6}


def test_time_is_read_as_written_in_any_session_zone(spark, places):
    root, raw_path, ledger = places
    land(root, "2024-01-01T05", [line()])
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        landing.load_hours(spark, root, raw_path, ledger)
        assert landing.raw_events(spark, raw_path, ledger).first().created_at == dt.datetime(2024, 1, 1, 5)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_loading_again_adds_nothing(spark, places):
    root, raw_path, ledger = places
    land(root, "2024-01-01T05", [line(), line(id="2")])
    land(root, "2024-01-01T06", [])
    first = report(landing.load_hours(spark, root, raw_path, ledger))
    assert first == {"2024-01-01-5.json.gz": (2, 0, "SUCCESS"), "2024-01-01-6.json.gz": (0, 0, "SUCCESS")}
    again = report(landing.load_hours(spark, root, raw_path, ledger))
    assert set(again.values()) == {(0, 0, "ALREADY_LOADED")}
    land(root, "2024-01-01T07", [line(id="3")])
    third = report(landing.load_hours(spark, root, raw_path, ledger))
    assert third["2024-01-01-7.json.gz"] == (1, 0, "SUCCESS")
    assert landing.raw_events(spark, raw_path, ledger).count() == 3
    assert len(list((os.walk(root)))) > 3  # landed files are kept


def test_hour_range_and_ledger_history(spark, places):
    root, raw_path, ledger = places
    for hour in range(4, 9):
        land(root, f"2024-01-01T{hour:02d}", [line(id=str(hour))])
    at = lambda hour: dt.datetime(2024, 1, 1, hour)
    got = report(landing.load_hours(spark, root, raw_path, ledger, at(5), at(7)))
    assert sorted(got) == [f"2024-01-01-{h}.json.gz" for h in (5, 6, 7)]
    assert landing.raw_events(spark, raw_path, ledger, at(6), at(6)).first().id == "6"
    old = ("year=2020/month=01/day=01/hour=00/x", "old", 1, 0, dt.datetime(2020, 1, 1), None, None, dt.date(2020, 1, 1))
    landing.publish_load(spark.createDataFrame([old], landing.LEDGER_SCHEMA), ledger)
    assert landing.read_ledger(spark, ledger).count() == 4
    assert landing.read_ledger(spark, ledger, history_days=180).count() == 3


def test_a_range_opens_its_own_folders(spark, places):
    root, raw_path, ledger = places
    for hour in (5, 6):
        land(root, f"2024-01-01T{hour:02d}", [line(id=str(hour)), b"{bad"])
    landing.load_hours(spark, root, raw_path, ledger)
    at = dt.datetime(2024, 1, 1, 6)
    raw = landing.raw_events(spark, raw_path, ledger, at, at)
    assert raw.inputFiles() and all("/load_status=loaded/" in f and "/hour=6/" in f for f in raw.inputFiles())
    late = landing.loaded_folders(spark, raw_path, ledger, after=dt.datetime(2024, 1, 1, 4))
    assert len(late) == 2 and landing.raw_of(spark, raw_path, late).count() == 2
    assert landing.loaded_folders(spark, raw_path, ledger, after=dt.datetime(2024, 1, 1, 5)) == []
    assert landing.newest_loaded(spark, ledger).first()[0] == dt.datetime(2024, 1, 1, 5)


def test_hour_spine_and_missing_hours(spark):
    spine = hours.hour_spine(spark, dt.date(2024, 2, 28), dt.date(2024, 3, 1))
    rows = spine.collect()
    assert len(rows) == 3 * 24
    assert rows[7].hour_key == "2024-02-28-7"
    assert rows[7].path == "year=2024/month=02/day=28/hour=07/2024-02-28-7.json.gz"
    loaded = spine.where(F.hour("hour") > 0).select("hour")
    missing = hours.missing_hours(spine, loaded)
    assert sorted(r.hour_key for r in missing.collect()) == ["2024-02-28-0", "2024-02-29-0", "2024-03-01-0"]


def test_previous_hour():
    assert hours.previous_hour(dt.datetime(2024, 1, 1, 0, 5)) == dt.datetime(2023, 12, 31, 23)
    zoned = dt.datetime(2024, 1, 1, 2, 30, tzinfo=dt.timezone.utc)
    assert hours.previous_hour(zoned) == dt.datetime(2024, 1, 1, 1)


def test_a_load_that_dies_is_never_seen(spark, places, monkeypatch):
    """Rows are written, and then the run dies before, or while, its entries are published."""
    root, raw_path, ledger = places
    land(root, "2024-01-01T05", [line(), line(id="2"), b"{bad"])
    for step in ("load_counts", "tables.write_by_day"):
        with monkeypatch.context() as patch:
            at = landing if step == "load_counts" else landing.tables
            patch.setattr(at, step.split(".")[-1], lambda *_, **__: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                landing.load_hours(spark, root, raw_path, ledger)
        assert landing.raw_events(spark, raw_path, ledger).count() == 0
    with monkeypatch.context() as patch:
        write = landing.tables.write_by_day
        patch.setattr(landing.tables, "write_by_day", lambda df, path, *a, **k: 1 / 0 if path == ledger else write(df, path, *a, **k))
        with pytest.raises(ZeroDivisionError):
            landing.load_hours(spark, root, raw_path, ledger)
    assert landing.loaded_folders(spark, raw_path, ledger, after=dt.datetime(2024, 1, 1)) == []
    assert landing.newest_loaded(spark, ledger).count() == 0
    assert report(landing.load_hours(spark, root, raw_path, ledger)) == {"2024-01-01-5.json.gz": (2, 1, "SUCCESS")}
    assert landing.raw_events(spark, raw_path, ledger).count() == 2
    assert landing.rejected_lines(spark, raw_path, ledger).count() == 1
    entry = landing.read_ledger(spark, ledger).first()
    assert (entry.rows_loaded, entry.errors_seen) == (2, 1)
    assert entry.first_created_at == entry.last_created_at == dt.datetime(2024, 1, 1, 5)
    assert len(landing.remove_unpublished(spark, raw_path, ledger)) == 3
    assert landing.raw_events(spark, raw_path, ledger).count() == 2


@pytest.mark.parametrize("most", [100, 0])
def test_new_files_of_a_half_loaded_hour(spark, places, monkeypatch, most):
    monkeypatch.setattr(landing, "MOST_NAMES", most)
    root, raw_path, ledger = places
    land(root, "2024-01-01T05", [line()])
    landing.load_hours(spark, root, raw_path, ledger)
    folder = f"{root}/{landing.hour_folder(dt.datetime(2024, 1, 1, 5))}"
    with gzip.open(f"{folder}/second.json.gz", "wb") as f:
        f.write(line(id="2") + b"\n")
    got = report(landing.load_hours(spark, root, raw_path, ledger))
    assert got == {"2024-01-01-5.json.gz": (0, 0, "ALREADY_LOADED"), "second.json.gz": (1, 0, "SUCCESS")}
    assert landing.raw_events(spark, raw_path, ledger).count() == 2


def test_a_bounded_range_lists_its_own_folders(spark, places, monkeypatch):
    root, raw_path, ledger = places
    for hour in (5, 6, 7):
        land(root, f"2024-01-01T{hour:02d}", [line(id=str(hour))])
    at = dt.datetime(2024, 1, 1, 6)
    plan = landing.list_files(spark, root, at, at)._jdf.queryExecution().toString()
    assert "hour=06" in plan or landing.list_files(spark, root, at, at).inputFiles() == [
        f for f in landing.list_files(spark, root, at, at).inputFiles() if "hour=06" in f
    ]
    later = dt.datetime(2024, 2, 1)
    assert landing.load_hours(spark, root, raw_path, ledger, later, later).count() == 0


def test_copies_that_differ_in_the_payload_only(spark, places):
    """The same row stays by either dedup and in either order of loading."""
    from tidemark.operators.dedup import first_seen, first_stored
    from tidemark.plans import staging

    kept = set()
    for turn, order in enumerate([(1, 2, 3), (3, 1, 2), (2, 3, 1)]):
        root, raw_path, ledger = [f"{p}-{turn}" for p in places]
        for hour, x in zip((5, 6, 7), order):
            land(root, f"2024-01-01T{hour:02d}", [line(payload={"x": x})])
            at = dt.datetime(2024, 1, 1, hour)
            landing.load_hours(spark, root, raw_path, ledger, at, at)
        raw = landing.raw_events(spark, raw_path, ledger)
        by = staging.copies_by(raw)
        for found in (first_stored(staging.typed(raw), tie_break=by), first_seen(staging.typed(raw), tie_break=by),
                      staging.stage_events(raw), staging.stage_to_store(raw)):
            kept.add(found.select(F.to_json("payload")).first()[0])
    assert len(kept) == 1
