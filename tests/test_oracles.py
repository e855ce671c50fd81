"""Every registered query against its DuckDB statement, on whole tables."""

import pytest
from compare import connect, duck_bag, spark_bag

import __spark_entry__ as contract
from oracles import ORACLES
from tidemark.plans.catalog import QUERIES

FOLDER = "/root/testdata/sf0.001"
TYPES = {
    "bigint": "BIGINT",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    con = connect(FOLDER)
    yield con
    con.close()


def test_every_statement_has_a_query():
    assert set(ORACLES) == set(QUERIES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, duck, name):
    sql = contract.oracle_sql()[name]
    df = contract.queries()[name](spark, FOLDER)
    assert spark_bag(df) == duck_bag(duck, sql)
    declared = {row[0]: row[1] for row in duck.execute(f"DESCRIBE {sql}").fetchall()}
    assert {c: TYPES[t] for c, t in df.dtypes} == declared


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_insight_feed_is_json_of_all_sections(spark):
    import json

    rows = contract.queries()["insight_feed"](spark, FOLDER).collect()
    assert {r["section"] for r in rows} == {"trending_repos", "language_trends", "label_usage"}
    ranks = [json.loads(r["item"])["trending_rank"] for r in rows if r["section"] == "trending_repos"]
    assert min(ranks) == 1 and max(ranks) <= 10


def test_scan_collects_no_files(spark, monkeypatch):
    from tidemark.plans import catalog

    def refuse(*_, **__):
        raise AssertionError("files were listed on the driver")

    monkeypatch.setattr(catalog.landing, "list_files", refuse)
    assert catalog.raw_json_scan(spark, FOLDER).count() > 0
