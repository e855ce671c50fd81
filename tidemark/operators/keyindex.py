"""Which days of a day table may hold a key: key hashes and days, in buckets by hash.

Pairs are only ever added, so that the index names every day that holds a key, and
perhaps days that did; who asks looks at the key column of the days that it names.
Which version of each day is in it is noted, and ``update`` adds the days
that have another one, by their key column alone. ``fold`` writes the pairs anew
as they are now, into a generation of their own; a generation counts once it is
complete.

Ids need no order: an index of random ids is read in the buckets of the keys asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark import tables

BUCKETS = 64
HASH, BUCKET = "key_hash", "bucket"
SCHEMA = T.StructType(
    [
        T.StructField(HASH, T.LongType()),
        T.StructField(tables.DAY, T.DateType()),
        T.StructField(BUCKET, T.IntegerType()),
    ]
)


def index_path(path: str) -> str:
    return f"{path}_keys"


def _generations(spark: SparkSession, path: str) -> list[int]:
    names = [n for n in tables.child_names(spark, path) if n.startswith("generation=")]
    return sorted(int(n.split("=")[1]) for n in names)


def _live(spark: SparkSession, path: str) -> str | None:
    """The newest complete generation."""
    for number in reversed(_generations(spark, path)):
        if tables.exists(spark, f"{path}/generation={number}/_SUCCESS"):
            return f"{path}/generation={number}"
    return None


def _hashed(key: Column) -> list[Column]:
    hash_ = F.xxhash64(key)
    return [hash_.alias(HASH), F.pmod(hash_, F.lit(BUCKETS)).cast("int").alias(BUCKET)]


def pairs(rows: DataFrame, key: str) -> DataFrame:
    """The index rows of a frame of keys and days."""
    return rows.where(F.col(key).isNotNull()).select(*_hashed(F.col(key)), tables.DAY).distinct()


def read(spark: SparkSession, path: str) -> DataFrame:
    """All pairs of the index of the table at ``path``, some more than once."""
    live = _live(spark, index_path(path))
    if live is None:
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).option("basePath", live).parquet(live)


def _add(found: DataFrame, at: str) -> None:
    written = found.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, HASH).write.mode("append")
    written.partitionBy(BUCKET).parquet(at)


def add(batch: DataFrame, path: str, key: str, known: dict) -> None:
    """Add the pairs of rows that are about to be published; ``known`` are the versions that are in the index then."""
    spark = batch.sparkSession
    _add(pairs(batch, key), _live(spark, index_path(path)) or f"{index_path(path)}/generation=1")
    tables.publish(spark, f"{index_path(path)}/_seen", known)


def update(spark: SparkSession, path: str, schema: T.StructType, key: str) -> None:
    """Add the days of the table at ``path`` whose live version the index doesn't know."""
    own = index_path(path)
    versions, seen = tables.versions(spark, path), tables.versions(spark, f"{own}/_seen")
    fresh = [day for day, version in versions.items() if seen.get(day) != version]
    if fresh or _live(spark, own) is None:
        add(tables.read_by_day(spark, path, schema, fresh), path, key, versions)


def note(spark: SparkSession, path: str) -> None:
    """Take the live versions as known: what they added is in the index already."""
    tables.publish(spark, f"{index_path(path)}/_seen", tables.versions(spark, path))


def candidates(keys: DataFrame, path: str, key: str) -> DataFrame:
    """``key`` and each day that may hold it. Hashes may collide: days can be too many, never too few."""
    asked = keys.where(F.col(key).isNotNull()).select(key, *_hashed(F.col(key)))
    return asked.join(read(keys.sparkSession, path), [BUCKET, HASH]).select(key, tables.DAY).distinct()


def fold(spark: SparkSession, path: str, schema: T.StructType, key: str) -> None:
    """Write the pairs of the live table as a new generation, and delete those before."""
    own = index_path(path)
    before = _generations(spark, own)
    number = max(before, default=0) + 1
    versions = tables.versions(spark, path)
    _add(pairs(tables.read_by_day(spark, path, schema), key), f"{own}/generation={number}")
    tables.publish(spark, f"{own}/_seen", versions)
    for old in before:
        tables.delete(spark, f"{own}/generation={old}")
