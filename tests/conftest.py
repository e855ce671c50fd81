from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]


@pytest.fixture(scope="session")
def spark():
    from tidemark import workspace
    from tidemark.session import local_session

    session = local_session(4, "tests", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    workspace.release(session)
    session.stop()


@pytest.fixture
def raw(spark):
    """Raw events from dicts of (id, type, actor, repo, payload, created_at)."""
    import json

    from pyspark.sql import functions as F

    def build(rows):
        fields = "id string, type string, actor string, repo string, payload string, at string"
        as_text = [
            (
                r.get("id"),
                r.get("type", "PushEvent"),
                *[json.dumps(r[c]) if c in r else None for c in ("actor", "repo", "payload")],
                r.get("at"),
            )
            for r in rows
        ]
        return spark.createDataFrame(as_text, fields).select(
            "id",
            "type",
            *[F.parse_json(c).alias(c) for c in ("actor", "repo", "payload")],
            F.col("at").cast("timestamp_ntz").alias("created_at"),
        )

    return build


@pytest.fixture
def events(spark):
    """Staged-like events from tuples (id, type, actor, login, repo, name, time)."""
    from pyspark.sql import functions as F

    def build(rows):
        fields = (
            "event_id string, event_type string, actor_id long, actor_login string, "
            "repo_id long, repo_name string, at string"
        )
        df = spark.createDataFrame(rows, fields)
        return df.withColumn("created_at", F.col("at").cast("timestamp_ntz")).drop("at")

    return build
