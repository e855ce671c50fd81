"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores, ``BENCH_RUNS`` the
runs per query after a warm-up run. Each time is a median, and covers building
the query, its pinned tables included, and writing every row to a null sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from datetime import timedelta

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark import workspace  # noqa: E402
from tidemark.plans import build, catalog  # noqa: E402
from tidemark.plans.catalog import QUERIES  # noqa: E402
from tidemark.session import local_session  # noqa: E402
from tidemark.sources import shapes  # noqa: E402

HEADLINE = [
    "stage_events",
    "upsert_result",
    "repo_daily_stats",
    "developer_activity",
    "category_daily",
    "trending_repos",
    "trending_parts",
    "rolling_7d_calendar",
    "cohort_retention",
    "category_trends",
    "category_trends_lineitem",
    "label_usage",
    "feed_trending",
    "dq_report",
    "dq_unique",
    "raw_json_scan",
    "marts_after_increment",
    "hourly_job",
]


def seconds(query, spark, folder: str) -> float:
    """Build and write one query; its pinned tables are deleted after it."""
    with workspace.scoped(spark):
        start = time.perf_counter()
        query(spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start


def hourly_job(spark, folder: str):
    """The whole job for the last landed hour, on tables that hold all hours before it."""
    import shutil
    import tempfile

    last = catalog.table(spark, folder, "events").agg(F.date_trunc("hour", F.max("ts"))).first()[0]
    if "job" not in _made:
        root = tempfile.mkdtemp(prefix="bench-")
        lines = shapes.lines_from_events(catalog.table(spark, folder, "events"))
        shapes.write_landing(lines, f"{root}/landing")
        before = build.Layout(f"{root}/before")
        build.run(spark, f"{root}/landing", before, end=last - timedelta(hours=1))
        _made["job"] = root
    root = _made["job"]
    # A copy for each run, so that every run finds the same tables.
    _made["runs"] = _made.get("runs", 0) + 1
    layout = build.Layout(f"{root}/run-{_made['runs']}")
    shutil.copytree(f"{root}/before", layout.root)
    start = time.perf_counter()
    report = build.run(spark, f"{root}/landing", layout, last, last)
    report.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


_made: dict = {}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores, "bench", **{"spark.sql.shuffle.partitions": cores.strip("*") or "8"})
    times = {}
    for name in names:
        if name == "hourly_job":
            timed = lambda: hourly_job(spark, folder)
        else:
            timed = lambda query=QUERIES[name]: seconds(query, spark, folder)
        timed()
        times[name] = round(statistics.median(timed() for _ in range(runs)), 3)
    workspace.release(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cores": cores,
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
