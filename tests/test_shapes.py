"""How the example tables are read: heavy columns are made after the rows are dealt out."""

from __future__ import annotations

from datetime import datetime, timedelta

from tidemark.sources import landing, shapes

KINDS = ("view", "click", "signup", "error", "purchase")


def events_of(spark, n: int):
    at = datetime(2024, 1, 5)
    rows = [(i, at + timedelta(minutes=7 * i), i % 9, KINDS[i % 5], f'{{"k": {i % 4}}}') for i in range(n)]
    return spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, props string")


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString().lower()


def test_lines_are_made_after_dealing(spark):
    lines = shapes.late_lines(events_of(spark, 300))
    above, below = plan(lines).split("repartitionbyexpression", 1)
    assert "ededed" in above and "ededed" not in below


def test_dealt_lines_hold_every_delivery(spark):
    lines = shapes.late_lines(events_of(spark, 300))
    assert lines.count() == 315
    late = lines.where("number = 3").select("day", "hour").collect()
    assert [tuple(r) for r in late] == [("05", "01")]


def test_blank_lines_are_found_without_a_copy(spark):
    texts = ["", " ", "\t \x0b\f\r", '{"id": "1"}', " x ", " ", None]
    lines = spark.createDataFrame([(t,) for t in texts], "value string")
    parsed = landing.parse_lines(lines)
    assert "regexp_replace" not in plan(parsed)
    assert sorted(r.bad_line or "" for r in parsed.select("bad_line").collect()) == ["", " x ", " "]


def test_events_are_dealt_before_they_are_built(spark):
    raw = shapes.raw_from_events(events_of(spark, 300).coalesce(1))
    above, below = plan(raw).split("rebalancepartitions", 1)
    assert "to_variant_object" in above and "to_variant_object" not in below
    assert raw.count() == 315
