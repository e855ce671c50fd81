"""A local session for tests and the bench, and settings for a cluster."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", name: str = "tidemark", **settings) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_settings(shuffled_bytes: int, partition_bytes: int = 128 << 20) -> dict[str, str]:
    """Settings for a job whose largest shuffle moves about ``shuffled_bytes``.

    Adaptive execution merges partitions that turn out small, and splits skewed
    ones, but never starts with more than the initial number.
    """
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(max(200, -(-shuffled_bytes // partition_bytes))),
    }
