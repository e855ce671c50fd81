"""Parquet tables partitioned by day, published by a manifest.

A write puts its days into a folder of its own version, beside what is there, and
then publishes a small manifest: the live version of each day. Readers resolve
days through the newest manifest, so a write that dies leaves the table as it
was. ``remove_old`` deletes what no kept manifest names. There is one writer.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

DAY = "date_day"
NULL_DAY = "__HIVE_DEFAULT_PARTITION__"
MANIFESTS = "_manifests"


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    files, folder = _folder(spark, path)
    return files.exists(folder)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder; none if it is not there."""
    files, folder = _folder(spark, path)
    if not files.exists(folder):
        return []
    return [status.getPath().getName() for status in files.listStatus(folder)]


def delete(spark: SparkSession, path: str) -> None:
    files, folder = _folder(spark, path)
    files.delete(folder, True)


def _day_name(day: date | None) -> str:
    return f"{DAY}={NULL_DAY if day is None else day.isoformat()}"


def _day_of(name: str) -> date | None:
    value = name.split("=", 1)[1]
    return None if value == NULL_DAY else date.fromisoformat(value)


def _newest(spark: SparkSession, path: str) -> int:
    numbers = [int(n.split(".")[0]) for n in child_names(spark, f"{path}/{MANIFESTS}") if n.endswith(".json")]
    return max(numbers, default=0)


def _read_names(spark: SparkSession, path: str, number: int) -> dict[str, str]:
    if not number:
        return {}
    files, file = _folder(spark, f"{path}/{MANIFESTS}/{number:012d}.json")
    stream = files.open(file)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _read_manifest(spark: SparkSession, path: str, number: int) -> dict[date | None, str]:
    """Each day's version."""
    return {_day_of(name): version for name, version in _read_names(spark, path, number).items()}


def _manifest(spark: SparkSession, path: str) -> tuple[int, dict[date | None, str]]:
    number = _newest(spark, path)
    return number, _read_manifest(spark, path, number)


def _publish(spark: SparkSession, path: str, number: int, names: dict[str, str]) -> None:
    """Make ``names`` the manifest: a rename puts it in its place as a whole."""
    name = f"{path}/{MANIFESTS}/{number:012d}.json"
    files, draft = _folder(spark, f"{name}.{uuid.uuid4().hex}.draft")
    stream = files.create(draft, False)
    try:
        stream.write(bytearray(json.dumps(names).encode()))
    finally:
        stream.close()
    if not files.rename(draft, spark._jvm.org.apache.hadoop.fs.Path(name)):
        raise RuntimeError(f"another writer has published {name}")


def _by_name(live: dict[date | None, str]) -> dict[str, str]:
    return {_day_name(day): version for day, version in live.items()}


def publish_names(spark: SparkSession, path: str, names: dict[str, str]) -> None:
    """Publish a manifest of other names than days; the last two stay."""
    number = _newest(spark, path) + 1
    _publish(spark, path, number, names)
    for name in child_names(spark, f"{path}/{MANIFESTS}"):
        if int(name.split(".")[0]) < number - 1:
            delete(spark, f"{path}/{MANIFESTS}/{name}")


def read_names(spark: SparkSession, path: str, back: int = 0) -> dict[str, str]:
    """The newest such manifest, or one of those before; empty if there is none."""
    return _read_names(spark, path, max(0, _newest(spark, path) - back))


def versions(spark: SparkSession, path: str) -> dict[date | None, str]:
    """The live version of each day."""
    return _manifest(spark, path)[1]


def publish(spark: SparkSession, path: str, live: dict[date | None, str]) -> None:
    """Publish days and versions alone: a note of what another table has seen."""
    publish_names(spark, path, _by_name(live))


def published(spark: SparkSession, path: str) -> bool:
    return _newest(spark, path) > 0


def days(spark: SparkSession, path: str) -> list[date | None]:
    """Live days, oldest first, the NULL day before all."""
    live = _manifest(spark, path)[1]
    return ([None] if None in live else []) + sorted(day for day in live if day is not None)


def on_days(wanted: Iterable[date | None]) -> Column:
    """Partition filter for a set of days, NULL included."""
    wanted = list(wanted)
    match = F.col(DAY).isin([d for d in wanted if d is not None])
    return match | F.col(DAY).isNull() if None in wanted else match


def read_by_day(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    only: Iterable[date | None] | None = None,
    number: int | None = None,
) -> DataFrame:
    """The table, or some of its days: other days' folders are not even listed.

    ``number`` reads the table as of that manifest.
    """
    live = _read_manifest(spark, path, _newest(spark, path) if number is None else number)
    wanted = live if only is None else [day for day in set(only) if day in live]
    folders = [f"{path}/{live[day]}/{_day_name(day)}" for day in wanted]
    stored = T.StructType([f for f in schema.fields if f.name != DAY]).add(DAY, T.DateType())
    if not folders:
        return spark.createDataFrame([], stored)
    # The versions are folders of partitions too; their column is left out.
    return spark.read.schema(stored).option("basePath", path).parquet(*folders).select(*stored.names)


def newest_number(spark: SparkSession, path: str) -> int:
    """Number of the newest manifest, 0 if there is none."""
    return _newest(spark, path)


def write_by_day(
    df: DataFrame, path: str, key: str, replace: Iterable[date | None] | None = None
) -> int:
    """Replace the table, or with ``replace`` those days; of them, those without rows in ``df`` go.

    Returns the number of the new manifest.

    The rebalance hint gathers each day into few files and lets adaptive
    execution split a day that is larger than the advisory partition size. The
    writer sorts by day anyway; sorting by key as well makes key ranges of row
    groups narrow.
    """
    spark = df.sparkSession
    number, live = _manifest(spark, path)
    version = f"version={number + 1:012d}-{uuid.uuid4().hex}"
    (
        df.hint("rebalance", DAY)
        .sortWithinPartitions(DAY, key)
        .write.partitionBy(DAY)
        .parquet(f"{path}/{version}")
    )
    names = child_names(spark, f"{path}/{version}")
    written = {_day_of(name): version for name in names if name.startswith(f"{DAY}=")}
    if replace is None:
        live = {}
    else:
        replaced = set(replace)
        live = {day: v for day, v in live.items() if day not in replaced and day not in written}
    _publish(spark, path, number + 1, _by_name(live | written))
    return number + 1


def remove_old(spark: SparkSession, path: str, keep: int = 2, numbers: Iterable[int] | None = None) -> None:
    """Delete the day folders that none of the last ``keep`` manifests names, or none of ``numbers``, and older manifests."""
    number = _newest(spark, path)
    kept = sorted(numbers) if numbers is not None else range(max(1, number - keep + 1), number + 1)
    if not kept:
        return
    named = {f"{v}/{_day_name(day)}" for n in kept for day, v in _read_manifest(spark, path, n).items()}
    for version in child_names(spark, path):
        if not version.startswith("version="):
            continue
        # A version beyond the newest manifest may be a write at work.
        if int(version.split("=")[1].split("-")[0]) > number:
            continue
        days_ = [n for n in child_names(spark, f"{path}/{version}") if n.startswith(f"{DAY}=")]
        unnamed = [n for n in days_ if f"{version}/{n}" not in named]
        for name in unnamed if len(unnamed) < len(days_) else [""]:
            delete(spark, f"{path}/{version}/{name}".rstrip("/"))
    for name in child_names(spark, f"{path}/{MANIFESTS}"):
        if int(name.split(".")[0]) < kept[0]:
            delete(spark, f"{path}/{MANIFESTS}/{name}")


def newest_instant(spark: SparkSession, path: str, schema: T.StructType, at: str) -> datetime | None:
    """Greatest ``at`` of a table partitioned by its day; reads the last day only."""
    for day in reversed([d for d in days(spark, path) if d is not None]):
        value = read_by_day(spark, path, schema, [day]).agg(F.max(at)).first()[0]
        if value is not None:
            return value
    return None
