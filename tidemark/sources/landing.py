"""Hourly gzipped JSON-lines files to the raw event table.

Files lie at ``<root>/year=YYYY/month=MM/day=DD/hour=HH/YYYY-MM-DD-H.json.gz``.
A gzip file is read by one task and its rows stay there: one pass parses,
sorts out bad lines and writes, without a shuffle.
"""

from __future__ import annotations

import uuid
from collections.abc import Collection, Iterable
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark import tables, workspace
from tidemark.functions.expressions import instant

RAW_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("actor", T.VariantType()),
        T.StructField("repo", T.VariantType()),
        T.StructField("payload", T.VariantType()),
        T.StructField("created_at", T.TimestampNTZType()),
    ]
)
HOUR_COLUMNS = ["year", "month", "day", "hour"]
PATH_SCHEMA = T.StructType([T.StructField(c, T.IntegerType()) for c in HOUR_COLUMNS])

# Stored form: the raw columns, a hash of the line, which run loaded each row from
# which file, and, for a line that could not be loaded, the line itself and why.
# Partitioned by load_id, then load_status, then the file's hour.
STORED_SCHEMA = T.StructType(
    [
        *RAW_SCHEMA.fields,
        T.StructField("line_hash", T.LongType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("bad_line", T.StringType()),
        T.StructField("bad_reason", T.StringType()),
        T.StructField("load_id", T.StringType()),
        T.StructField("load_status", T.StringType()),
        *PATH_SCHEMA.fields,
    ]
)
# The files loaded so far, by the day of their hour. A load is there once its
# entries are published, all together; it names the folders that readers open.
LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("source_file", T.StringType()),
        T.StructField("load_id", T.StringType()),
        T.StructField("rows_loaded", T.LongType()),
        T.StructField("errors_seen", T.LongType()),
        T.StructField("loaded_at", T.TimestampType()),
        T.StructField("first_created_at", T.TimestampNTZType()),
        T.StructField("last_created_at", T.TimestampNTZType()),
        T.StructField(tables.DAY, T.DateType()),
    ]
)
# How late the events of an hour's files are, by the day of the newest one.
REACH_SCHEMA = T.StructType(
    [
        T.StructField("hour", T.TimestampNTZType()),
        T.StructField("load_id", T.StringType()),
        T.StructField("last_created_at", T.TimestampNTZType()),
        T.StructField(tables.DAY, T.DateType()),
    ]
)
LOADED, REJECTED = "loaded", "rejected"
FILES = "*.gz"
#: Loaded files of half-loaded hours whose names are broadcast; more are joined.
MOST_NAMES = 100_000


def path_hour() -> Column:
    """The hour that the partition folders name."""
    return F.make_timestamp_ntz(*HOUR_COLUMNS, F.lit(0), F.lit(0).cast("decimal(16,6)"))


def in_hours(start: datetime | None, end: datetime | None) -> Column:
    """Partition filter on file hours, inclusive at both ends."""
    wanted = F.lit(True)
    if start is not None:
        wanted = wanted & (path_hour() >= instant(start))
    if end is not None:
        wanted = wanted & (path_hour() <= instant(end))
    return wanted


def hour_folder(hour: datetime) -> str:
    return f"year={hour:%Y}/month={hour:%m}/day={hour:%d}/hour={hour:%H}"


def stored_folder(hour: datetime) -> str:
    """The same in the raw table, whose folders Spark names after numbers."""
    return f"year={hour.year}/month={hour.month}/day={hour.day}/hour={hour.hour}"


def landed_hours(
    spark: SparkSession, root: str, start: datetime | None, end: datetime | None
) -> list[datetime] | None:
    """The hours of a bounded range that have a folder; None for an open range.

    One listing per day of the range, whatever else is landed.
    """
    if start is None or end is None:
        return None
    found, day = [], start.replace(hour=0, minute=0, second=0, microsecond=0)
    while day <= end:
        names = tables.child_names(spark, f"{root}/{hour_folder(day).rpartition('/')[0]}")
        hours = [day.replace(hour=int(n.split("=")[1])) for n in names if n.startswith("hour=")]
        found += [h for h in sorted(hours) if start <= h <= end]
        day += timedelta(days=1)
    return found


def at_hours(hours: Collection[datetime]) -> Column:
    """Partition filter for a choice of file hours."""
    return path_hour().isin([instant(hour) for hour in hours])


def relative_path(full: Column) -> Column:
    """A file's identity: its path below the landing root."""
    return F.regexp_extract(full, r"(year=[^/]+/.*)$", 1)


def parse_lines(lines: DataFrame, text: str = "value") -> DataFrame:
    """Add the raw columns to a frame of JSON lines, and sort out bad lines.

    Bytes that are not UTF-8 are replaced, not refused. A line is bad if it is
    not JSON, or if its time is present but is none. Blank lines are no rows.
    """
    clean = F.make_valid_utf8(F.col(text))
    others = [c for c in lines.columns if c != text]
    at = F.try_variant_get("_v", "$.created_at", "string")
    parsed = (
        lines.select(clean.alias("_line"), *others)
        .where(F.col("_line").rlike(r"\S"))
        .withColumn("_v", F.try_parse_json("_line"))
        .select(
            F.try_variant_get("_v", "$.id", "string").alias("id"),
            F.try_variant_get("_v", "$.type", "string").alias("type"),
            F.try_variant_get("_v", "$.actor", "variant").alias("actor"),
            F.try_variant_get("_v", "$.repo", "variant").alias("repo"),
            F.try_variant_get("_v", "$.payload", "variant").alias("payload"),
            at.try_cast("timestamp_ntz").alias("created_at"),
            F.when(F.col("_v").isNull(), "not JSON")
            .when(at.isNotNull() & at.try_cast("timestamp_ntz").isNull(), "not a time")
            .alias("bad_reason"),
            F.xxhash64("_line").alias("line_hash"),
            "_line",
            *others,
        )
    )
    good = F.col("bad_reason").isNull()
    return parsed.withColumns(
        {
            "bad_line": F.when(~good, F.col("_line")),
            "load_status": F.when(good, LOADED).otherwise(REJECTED),
        }
    ).drop("_line")


def list_files(
    spark: SparkSession, root: str, start: datetime | None = None, end: datetime | None = None
) -> DataFrame:
    """Landed files by path; their content is not read. A bounded range lists its own folders only."""
    hours = landed_hours(spark, root, start, end)
    schema = T.StructType([T.StructField("path", T.StringType()), *PATH_SCHEMA.fields])
    if hours == []:
        files = spark.createDataFrame([], schema)
    else:
        paths = root if hours is None else [f"{root}/{hour_folder(h)}" for h in hours]
        files = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", FILES)
            .option("basePath", root)
            .load(paths)
            .select("path", *[F.col(c).cast("int") for c in HOUR_COLUMNS])
        )
    return files.where(in_hours(start, end)).withColumn(
        "source_file", relative_path(F.col("path"))
    )


def unloaded(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files that the ledger does not hold."""
    return files.join(ledger.select("source_file"), "source_file", "left_anti")


def read_ledger(
    spark: SparkSession,
    path: str,
    history_days: int | None = None,
    only: Iterable[date] | None = None,
) -> DataFrame:
    """Files loaded so far, or those of some days' hours; with ``history_days``, only those remembered that long."""
    ledger = tables.read_by_day(spark, path, LEDGER_SCHEMA, only)
    if history_days is None:
        return ledger
    kept_from = F.current_timestamp() - F.expr(f"INTERVAL {int(history_days)} DAYS")
    return ledger.where(F.col("loaded_at") >= kept_from)


def days_between(start: datetime | None, end: datetime | None) -> list[date] | None:
    """The days of a bounded range; None for an open one."""
    if start is None or end is None:
        return None
    return [start.date() + timedelta(days=i) for i in range((end.date() - start.date()).days + 1)]


def reach_path(ledger_path: str) -> str:
    return f"{ledger_path}_reach"


def file_hour() -> Column:
    """The hour that a ledger path names."""
    folder = r"year=(\d+)/month=(\d+)/day=(\d+)/hour=(\d+)/"
    parts = [F.regexp_extract("source_file", folder, i).cast("int") for i in range(1, 5)]
    return F.make_timestamp_ntz(*parts, F.lit(0), F.lit(0).cast("decimal(16,6)"))


def loaded_hours(ledger: DataFrame) -> DataFrame:
    """The hours that the ledger's paths name, as a column ``hour``."""
    return ledger.select(file_hour().alias("hour")).distinct()


def scan_lines(spark: SparkSession, paths: str | list[str], root: str) -> DataFrame:
    """Parsed lines of the files below ``paths``, with their hour and source file."""
    lines = (
        spark.read.option("basePath", root)
        .option("pathGlobFilter", FILES)
        .option("lineSep", "\n")
        .text(paths)
        .select(
            "value",
            *[F.col(c).cast("int") for c in HOUR_COLUMNS],
            relative_path(F.col("_metadata.file_path")).alias("source_file"),
        )
    )
    parsed = parse_lines(lines).withColumn("load_id", F.lit(None).cast("string"))
    return parsed.select(*STORED_SCHEMA.names)


def load_hours(
    spark: SparkSession,
    root: str,
    raw_path: str,
    ledger_path: str,
    start: datetime | None = None,
    end: datetime | None = None,
    history_days: int | None = None,
) -> DataFrame:
    """Load the landed files of an hour range that are not in the ledger yet.

    Returns one row per file of the range: rows loaded, lines refused, status.
    Landed files are kept. Loading the same range again adds nothing. The
    driver holds the hours to load, never the files. A load's rows lie in a folder
    of its own, and readers open those that the ledger names: what a run wrote
    that died is never seen, and the next run loads its files anew.
    """
    files = list_files(spark, root, start, end)
    ledger = read_ledger(spark, ledger_path, history_days, days_between(start, end))
    pending = workspace.pin(unloaded(files, ledger).select("source_file", *HOUR_COLUMNS), "pending")
    hours = [datetime(*row) for row in pending.select(*HOUR_COLUMNS).distinct().collect()]
    load_id = uuid.uuid4().hex
    if hours:
        lines = scan_lines(spark, [f"{root}/{hour_folder(h)}" for h in sorted(hours)], root)
        known = files.where(at_hours(hours)).join(ledger, "source_file", "left_semi")
        known = workspace.pin(known.select("source_file"), "known")
        few = known.limit(MOST_NAMES + 1).count()
        if few:
            names = F.broadcast(known) if few <= MOST_NAMES else known
            lines = lines.join(names, "source_file", "left_anti").select(*STORED_SCHEMA.names)
        folder = f"{raw_path}/load_id={load_id}"
        lines.drop("load_id").write.partitionBy("load_status", *HOUR_COLUMNS).parquet(folder)
        counts = load_counts(read_stored(spark, raw_path, [folder]))
        entries = pending.join(counts, "source_file", "left").select(
            "source_file",
            F.lit(load_id).alias("load_id"),
            F.coalesce("rows_loaded", F.lit(0)).cast("bigint").alias("rows_loaded"),
            F.coalesce("errors_seen", F.lit(0)).cast("bigint").alias("errors_seen"),
            F.current_timestamp().alias("loaded_at"),
            "first_created_at",
            "last_created_at",
            file_hour().cast("date").alias(tables.DAY),
        )
        publish_load(workspace.pin(entries, "entries"), ledger_path)
    fresh = read_ledger(spark, ledger_path, only={h.date() for h in hours})
    return load_report(files, fresh.where(F.col("load_id") == load_id))


def publish_load(entries: DataFrame, ledger_path: str) -> None:
    """Make a load visible: its ledger entries join those of their days in one step.

    How far its events reach is noted first; a note without ledger entries is
    passed over. Of both tables the touched days are written anew.
    """
    spark = entries.sparkSession
    reach = entries.where(F.col("last_created_at").isNotNull()).groupBy(file_hour().alias("hour"), "load_id").agg(
        F.max("last_created_at").alias("last_created_at")
    )
    reach = reach.withColumn(tables.DAY, F.to_date("last_created_at"))
    for rows, path, schema, key in (
        (reach, reach_path(ledger_path), REACH_SCHEMA, "hour"),
        (entries, ledger_path, LEDGER_SCHEMA, "source_file"),
    ):
        days = {row[0] for row in rows.select(tables.DAY).distinct().collect()}
        if days:
            before = tables.read_by_day(spark, path, schema, days)
            tables.write_by_day(before.unionByName(rows.select(*before.columns)), path, key, replace=days)
            tables.remove_old(spark, path)


def load_counts(stored: DataFrame) -> DataFrame:
    """Per source file: rows loaded, lines refused, and the span of the loaded rows' times."""
    loaded = F.col("load_status") == LOADED
    at = F.when(loaded, F.col("created_at"))
    return stored.groupBy("source_file").agg(
        F.count_if(loaded).alias("rows_loaded"),
        F.count_if(F.col("load_status") == REJECTED).alias("errors_seen"),
        F.min(at).alias("first_created_at"),
        F.max(at).alias("last_created_at"),
    )


def folders(raw_path: str, ledger: DataFrame, status: str = LOADED) -> list[str]:
    """The hour folders of the raw table that ledger entries name; one per load and hour."""
    rows = ledger.where(F.col("rows_loaded" if status == LOADED else "errors_seen") > 0)
    named = rows.select(file_hour().alias("hour"), "load_id").distinct().collect()
    return sorted(f"{raw_path}/load_id={r['load_id']}/load_status={status}/{stored_folder(r['hour'])}" for r in named)


def loaded_folders(
    spark: SparkSession,
    raw_path: str,
    ledger_path: str,
    start: datetime | None = None,
    end: datetime | None = None,
    after: datetime | None = None,
) -> list[str]:
    """Hour folders of loaded rows, of a range of file hours, or those that hold an event later than ``after``.

    The latter are found by the days of the newest events, whatever the hour of
    their file; the ledger is then read for their days alone.
    """
    if after is None:
        ledger = read_ledger(spark, ledger_path, only=days_between(start, end))
    else:
        reach = reach_path(ledger_path)
        late = [d for d in tables.days(spark, reach) if d is not None and d >= after.date()]
        found = tables.read_by_day(spark, reach, REACH_SCHEMA, late).where(F.col("last_created_at") > instant(after))
        found = workspace.pin(found.select("hour", "load_id").distinct(), "reaching")
        days = [row[0] for row in found.select(F.to_date("hour")).distinct().collect()]
        ledger = read_ledger(spark, ledger_path, only=days).withColumn("hour", file_hour())
        ledger = ledger.join(found, ["hour", "load_id"], "left_semi")
    hour = file_hour()
    if start is not None:
        ledger = ledger.where(hour >= instant(start))
    if end is not None:
        ledger = ledger.where(hour <= instant(end))
    return folders(raw_path, ledger)


def newest_loaded(spark: SparkSession, ledger_path: str) -> DataFrame:
    """``created_at`` of the newest loaded event, at most one row; read from the last days that have one."""
    reach = reach_path(ledger_path)
    for day in reversed([d for d in tables.days(spark, reach) if d is not None]):
        found = tables.read_by_day(spark, reach, REACH_SCHEMA, [day])
        at = found.where(F.to_date("hour").isNotNull()).select("load_id", "last_created_at", F.to_date("hour").alias("of"))
        days = [row[0] for row in at.select("of").distinct().collect()]
        known = read_ledger(spark, ledger_path, only=days).select("load_id").distinct()
        newest = at.join(known, "load_id", "left_semi").agg(F.max("last_created_at").alias("created_at"))
        if newest.first()[0] is not None:
            return newest
    return spark.createDataFrame([], "created_at timestamp_ntz")


def remove_unpublished(spark: SparkSession, raw_path: str, ledger_path: str) -> list[str]:
    """Delete what loads left that were never published. Not while a load is at work."""
    named = {f"load_id={r[0]}" for r in read_ledger(spark, ledger_path).select("load_id").distinct().collect()}
    left = [n for n in tables.child_names(spark, raw_path) if n.startswith("load_id=") and n not in named]
    for name in left:
        tables.delete(spark, f"{raw_path}/{name}")
    return left


def load_report(files: DataFrame, fresh: DataFrame) -> DataFrame:
    """Outcome per file: counts for those just loaded, none for the others."""
    counts = fresh.groupBy("source_file").agg(
        F.max_by("rows_loaded", "loaded_at").alias("rows_loaded"),
        F.max_by("errors_seen", "loaded_at").alias("errors_seen"),
    )
    return (
        files.select("source_file")
        .join(counts, "source_file", "left")
        .select(
            "source_file",
            F.coalesce("rows_loaded", F.lit(0)).cast("bigint").alias("rows_loaded"),
            F.coalesce("errors_seen", F.lit(0)).cast("bigint").alias("errors_seen"),
            F.when(F.col("rows_loaded").isNull(), "ALREADY_LOADED")
            .otherwise("SUCCESS")
            .alias("status"),
        )
    )


def as_stored(raw: DataFrame) -> DataFrame:
    """Raw events that came another way, in the stored form."""
    at = F.col("created_at")
    missing = ("load_id", "source_file", "bad_line", "bad_reason")
    whole = F.struct(*[F.to_json(c) if c in ("actor", "repo", "payload") else F.col(c) for c in RAW_SCHEMA.names])
    return raw.withColumns(
        {
            "line_hash": F.xxhash64(whole),
            **{c: F.lit(None).cast("string") for c in missing},
            "load_status": F.lit(LOADED),
            "year": F.year(at),
            "month": F.month(at),
            "day": F.dayofmonth(at),
            "hour": F.hour(at),
        }
    ).select(*STORED_SCHEMA.names)


def read_stored(spark: SparkSession, raw_path: str, paths: list[str]) -> DataFrame:
    """Rows of the raw table below ``paths``; nothing else is listed."""
    if not paths:
        return spark.createDataFrame([], STORED_SCHEMA)
    return spark.read.schema(STORED_SCHEMA).option("basePath", raw_path).parquet(*paths)


def raw_of(spark: SparkSession, raw_path: str, paths: list[str]) -> DataFrame:
    return read_stored(spark, raw_path, paths).select(*RAW_SCHEMA.names, "line_hash")


def raw_events(
    spark: SparkSession,
    raw_path: str,
    ledger_path: str,
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """The raw event table with the hash of each line, or what files of a range of hours hold."""
    return raw_of(spark, raw_path, loaded_folders(spark, raw_path, ledger_path, start, end))


def rejected_lines(spark: SparkSession, raw_path: str, ledger_path: str) -> DataFrame:
    paths = folders(raw_path, read_ledger(spark, ledger_path), REJECTED)
    return read_stored(spark, raw_path, paths).select("source_file", "bad_reason", "bad_line")
