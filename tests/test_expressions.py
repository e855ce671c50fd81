import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions import expressions as X


def test_all_types_have_their_category(spark):
    expected = dict(X.EVENT_CATEGORIES, **{"watchevent": "other", "NewEvent": "other"})
    rows = [(t,) for t in expected] + [(None,)]
    df = spark.createDataFrame(rows, "t string")
    got = {r["t"]: r["c"] for r in df.select("t", X.event_category(F.col("t")).alias("c")).collect()}
    assert got == {**expected, None: "other"}
    assert len(X.EVENT_CATEGORIES) == 16 and len(set(X.EVENT_CATEGORIES.values())) == 8


def test_count_category_agrees_with_the_category(spark):
    rows = [(t,) for t in X.EVENT_CATEGORIES] + [(None,), ("NewEvent",)]
    df = spark.createDataFrame(rows, "t string")
    for name in set(X.EVENT_CATEGORIES.values()):
        by_member = df.agg(X.count_category(F.col("t"), name)).first()[0]
        assert by_member == df.where(X.event_category(F.col("t")) == name).count()


def test_custom_mapping(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "t string")
    mapping = {"a": "one", "b": "two"}
    got = [r[0] for r in df.select(X.event_category(F.col("t"), mapping, "rest")).collect()]
    assert got == ["one", "two", "rest"]
    assert df.select(X.event_category(F.col("t"), {})).distinct().first()[0] == "other"


def test_safe_divide(spark):
    df = spark.createDataFrame([(1, 2), (1, 0), (1, None), (None, 2)], "a long, b long")
    got = [r[0] for r in df.select(X.safe_divide(F.col("a"), F.col("b"))).collect()]
    assert got == [0.5, None, None, None]


def test_months_apart_counts_boundaries(spark):
    df = spark.createDataFrame(
        [(dt.date(2024, 1, 31), dt.date(2024, 2, 1)), (dt.date(2023, 12, 1), dt.date(2024, 12, 31))],
        "a date, b date",
    )
    assert [r[0] for r in df.select(X.months_apart(F.col("a"), F.col("b"))).collect()] == [1, 12]


def test_surrogate_key_tells_null_from_text(spark):
    df = spark.createDataFrame([(None, "x"), ("", "x"), ("a", "x")], "a string, b string")
    keys = [r[0] for r in df.select(X.surrogate_key(F.col("a"), F.col("b"))).collect()]
    assert len(set(keys)) == 3 and all(len(k) == 32 for k in keys)


def test_latest_skips_null_and_settles_ties(spark):
    rows = [(1, "b"), (2, "x"), (2, "y"), (3, None)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "at long, name string")
        assert df.agg(X.latest(F.col("name"), F.col("at"))).first()[0] == "y"
    empty = spark.createDataFrame([(1, None)], "at long, name string")
    assert empty.agg(X.latest(F.col("name"), F.col("at"))).first()[0] is None


def test_hour_is_padded_in_the_folder_only(spark):
    at = X.instant(dt.datetime(2024, 3, 5, 7))
    row = spark.range(1).select(X.hour_key(at), X.hour_path(at)).first()
    assert row[0] == "2024-03-05-7"
    assert row[1] == "year=2024/month=03/day=05/hour=07/2024-03-05-7.json.gz"
