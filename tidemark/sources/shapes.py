"""Any event-like table in the shape that the operators read."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.sources.landing import HOUR_COLUMNS

# How the example tables' own kinds map to event types.
EVENT_KINDS = {
    "view": "WatchEvent",
    "click": "PushEvent",
    "signup": "ForkEvent",
    "error": "IssuesEvent",
    "purchase": "PullRequestEvent",
}
# Types that no kind maps to; one event in seven has one of these
# in turn, or a type that is no accepted one, or none.
OTHER_TYPES = (
    "CreateEvent",
    "DeleteEvent",
    "IssueCommentEvent",
    "PullRequestReviewEvent",
    "PullRequestReviewCommentEvent",
    "CommitCommentEvent",
    "ReleaseEvent",
    "PublicEvent",
    "MemberEvent",
    "GollumEvent",
    "SponsorshipEvent",
    "UnknownEvent",
    None,
)
# Fixed value: the day of the month before which there is no wiki event, so that
# the last days hold a category without a week before it.
WIKI_FROM = 25
PRIORITY_KINDS = {
    "1-URGENT": "PushEvent",
    "2-HIGH": "IssuesEvent",
    "3-MEDIUM": "WatchEvent",
    "4-NOT SPECIFIED": "ForkEvent",
    "5-LOW": "ForkEvent",
}
FLAG_KINDS = {"N": "PushEvent", "R": "WatchEvent", "A": "ForkEvent"}


def renamed(value: Column, kinds: Mapping[str, str]) -> Column:
    result = None
    for source, event_type in kinds.items():
        result = (F if result is None else result).when(value == source, event_type)
    return result


def _delivered(events: DataFrame) -> DataFrame:
    """Every delivery of each event, in few narrow columns; every twentieth event comes again an hour later."""
    again = F.col("event_id") % 20 == 0
    later = F.col("ts") + F.expr("INTERVAL 1 HOUR")
    return events.select(
        "event_id",
        "event_type",
        "user_id",
        "ts",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        F.explode(F.when(again, F.array("ts", later)).otherwise(F.array("ts"))).alias("at"),
    )


def _event_fields(delivered: DataFrame, *more: str) -> DataFrame:
    """Deliveries with nested actor, repo and payload structs, and the columns ``more``.

    Names change at noon, one event in 500 has no repo, one in 211 no actor, one
    in seven of those without labels another type, wiki events only late in the
    month; labels come zero to three at a time, one in forty without a name.
    """
    number = F.col("event_id")
    suffix = F.when(F.hour("at") >= 12, "-new").otherwise("")
    labels = [
        F.struct(
            F.when(
                (number * 7 + p * 3) % 40 != 39, F.concat(F.lit("label"), (number * 7 + p * 3) % 40)
            ).alias("name"),
            F.lit("ededed").alias("color"),
        )
        for p in range(4)
    ]
    others = F.array(*[F.lit(t).cast("string") for t in OTHER_TYPES])
    other = F.element_at(others, (number % len(OTHER_TYPES) + 1).cast("int"))
    early = (other == "GollumEvent") & (F.dayofmonth("ts") < WIKI_FROM)
    other = F.when(early, "SponsorshipEvent").otherwise(other)
    kind = renamed(F.col("event_type"), EVENT_KINDS)
    return delivered.select(
        number.cast("string").alias("id"),
        F.when((number % 7 == 3) & (kind != "PullRequestEvent"), other).otherwise(kind).alias("type"),
        F.when(
            number % 211 != 5,
            F.struct(
                F.col("user_id").alias("id"), F.concat(F.lit("u"), "user_id", suffix).alias("login")
            ),
        ).alias("actor"),
        F.when(
            number % 500 != 7,
            F.struct(
                F.col("k").alias("id"),
                F.concat(F.lit("org"), F.col("k") % 10, F.lit("/repo"), "k", suffix).alias("name"),
            ),
        ).alias("repo"),
        F.struct(
            F.when(number % 2 == 0, "labeled").otherwise("opened").alias("action"),
            F.struct((number % 1000).alias("number")).alias("pull_request"),
            F.slice(F.array(*labels), F.lit(1), (number % 4).cast("int")).alias("labels"),
        ).alias("payload"),
        F.col("at").alias("created_at"),
        *more,
    )


def raw_from_events(events: DataFrame) -> DataFrame:
    """The raw event table, built from ``events``.

    Their few narrow columns are dealt out first: a file of one row group is
    scanned by one task, which is not to build and sort all deliveries alone.
    """
    dealt = events.select("event_id", "event_type", "user_id", "ts", "props").hint("rebalance", "event_id")
    return _event_fields(_delivered(dealt)).select(
        "id",
        "type",
        *[F.to_variant_object(c).alias(c) for c in ("actor", "repo", "payload")],
        "created_at",
    )


def lines_from_events(events: DataFrame) -> DataFrame:
    """The same deliveries as JSON lines, some of them broken, with their hour.

    One line in 97 is cut short, and one in 89 carries no valid time.
    """
    return _lines(events, F.col("at"))


def late_lines(events: DataFrame) -> DataFrame:
    """The same in files of the hour after for a third of the events."""
    after = F.when(F.col("event_id").cast("bigint") % 3 == 0, 1).otherwise(0)
    return _lines(events, F.col("at") + F.make_dt_interval(hours=after))


def _lines(events: DataFrame, file_hour: Column) -> DataFrame:
    """JSON lines with their hour, dealt out in ranges of (hour, number) of even size.

    A task holds neighbouring hours, and an hour with most of the lines is split
    over many tasks. The narrow deliveries are dealt, and the lines made after
    that: dealing in ranges reads its input twice.
    """
    parts = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    delivered = _delivered(events).select(
        "*",
        F.date_format(file_hour, "yyyy").alias("year"),
        F.date_format(file_hour, "MM").alias("month"),
        F.date_format(file_hour, "dd").alias("day"),
        F.date_format(file_hour, "HH").alias("hour"),
    )
    fields = _event_fields(delivered.repartitionByRange(parts, *HOUR_COLUMNS, "event_id"), *HOUR_COLUMNS)
    number = F.col("id").cast("bigint")
    at = F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    line = F.to_json(
        F.struct(
            "id",
            "type",
            "actor",
            "repo",
            "payload",
            F.when(number % 89 == 5, "notatime").otherwise(at).alias("created_at"),
        )
    )
    whole = F.length(line)
    return fields.select(
        number.alias("number"),
        F.when(number % 97 == 0, F.substr(line, F.lit(1), whole - 1)).otherwise(line).alias("value"),
        *HOUR_COLUMNS,
    )


def write_landing(lines: DataFrame, root: str) -> None:
    """Land JSON lines as gzipped text in hour folders, as they are dealt out."""
    lines.drop("number").write.partitionBy(*HOUR_COLUMNS).option("compression", "gzip").text(root)


def activity_from_orders(orders: DataFrame) -> DataFrame:
    """``orders`` as staged events: customers act on fifty repos over years."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    return orders.select(
        key.cast("string").alias("event_id"),
        renamed(F.col("o_orderpriority"), PRIORITY_KINDS).alias("event_type"),
        customer.alias("actor_id"),
        F.concat(F.lit("c"), customer).alias("actor_login"),
        (key % 50).alias("repo_id"),
        F.concat(F.lit("repo"), key % 50).alias("repo_name"),
        F.col("o_orderdate").alias("created_at"),
    )


def activity_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """``lineitem`` as staged events: parts are repos, suppliers are actors.

    Rows have no key of their own, so this frame goes to the daily operators
    directly and not through the dedup.
    """
    return lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("event_id"),
        renamed(F.col("l_returnflag"), FLAG_KINDS).alias("event_type"),
        F.col("l_suppkey").alias("actor_id"),
        F.concat(F.lit("s"), "l_suppkey").alias("actor_login"),
        F.col("l_partkey").alias("repo_id"),
        F.concat(F.lit("part"), "l_partkey").alias("repo_name"),
        F.col("l_shipdate").alias("created_at"),
    )
