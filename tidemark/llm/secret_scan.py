"""Secrets in texts, in DataFrame functions only: patterns and sliding-window entropy.

Three kinds are found by pattern (``assign``, ``access``, ``hex``). The entropy
classes add spans: a candidate is a run of a class's alphabet; a window slides over
it with the counts of its characters, one entering and one leaving at each step,
and the candidate is a secret if the Shannon entropy of any window reaches the
class's limit. Spans found by pattern, and parts on the allow-list, cut a run: what is
left on either side is a candidate of its own. Candidates that the allow-list names
as a whole are passed over.

Positions are code points, ends exclusive. NULL is an empty text, without spans.
Repeated rows have the same spans each; spans that start together are in the order of
their kinds. A text is scanned whole, however long: finding the places of its
matches takes time with their square, as each step of Spark's fold copies the list.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}+"
#: Without a match of these a text has no span.
ASSIGN_GATE = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]"""
RUN_GATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}+"
KINDS = ("assign", "access", "hex")


@dataclass(frozen=True)
class EntropyClass:
    """``window`` characters of ``alphabet`` with an entropy of ``limit`` bits are a secret."""

    name: str
    alphabet: str
    window: int
    limit: float

    @property
    def pattern(self) -> str:
        chars = "[" + self.alphabet.replace("-", r"\-").replace("/", r"\/") + "]"
        return f"(?<!{chars}){chars}{{{self.window},}}+"


LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
CLASSES = (
    EntropyClass("hex_entropy", DIGITS + "abcdef", 16, 3.0),
    EntropyClass("base64_entropy", UPPER + LOWER + DIGITS + "+/_=-", 24, 3.9),
)
#: Candidates that match one of these as a whole are no secrets: words, numbers, slugs
#: and paths, UUIDs.
ALLOWED = (
    r"^[A-Za-z=]+$",
    r"^[0-9=]+$",
    r"^[a-z0-9]{0,15}([-_/][a-z0-9]{0,15})+$",
    r"^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$",
)
#: No window reaches into one of these, each with its length: example keys, keyboard
#: and alphabet runs, a date at the beginning of a run.
ALLOWED_PARTS = (
    (r"(?i)example", 7),
    (r"(?i)abcdefgh|01234567|qwertyui", 8),
    (r"(?<![A-Za-z0-9+/_=-])[0-9]{4}-[0-9]{2}-[0-9]{2}", 10),
)

SPAN = "array<struct<start:int,end:int,value:string>>"


def matches(text: Column, pattern: str) -> Column:
    """All matches of ``pattern``, with their places: what lies between them is counted.

    ``pattern`` must not match the empty text.
    """
    pairs = F.arrays_zip(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))

    def step(done: Column, pair: Column) -> Column:
        start = done["at"] + F.char_length(pair["0"])
        end = start + F.char_length(pair["1"])
        span = F.struct(start.alias("start"), end.alias("end"), pair["1"].alias("value"))
        return F.struct(end.alias("at"), F.array_append(done["spans"], span).alias("spans"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))
    whole = F.filter(pairs, lambda p: p["1"].isNotNull())
    return F.reduce(whole, zero, step, lambda done: done["spans"])


def peak_entropy(value: Column, kind: EntropyClass) -> Column:
    """The largest entropy, in bits, of any window of ``value``; -1 if it is shorter."""
    w = kind.window
    term = F.array(*[F.lit(n * math.log2(n) if n else 0.0) for n in range(w + 2)])
    place = lambda i: F.instr(F.lit(kind.alphabet), F.substring(value, i, F.lit(1)))
    codes = F.transform(F.sequence(F.lit(1), F.char_length(value)), place)
    leaving = F.concat(F.array_repeat(F.lit(0), w), codes)
    pairs = F.filter(F.arrays_zip(codes, leaving), lambda p: p["0"].isNotNull())

    def step(at: Column, pair: Column) -> Column:
        enter, leave = pair["0"], pair["1"]
        n = F.element_at(at["counts"], enter)
        m = F.when(leave > 0, F.element_at(at["counts"], F.greatest(leave, F.lit(1))))
        gained = F.element_at(term, n + 2) - F.element_at(term, n + 1)
        lost = F.when(leave > 0, F.element_at(term, m + 1) - F.element_at(term, F.greatest(m, F.lit(1)))).otherwise(0.0)
        total = F.when(enter == leave, at["total"]).otherwise(at["total"] + gained - lost)
        counts = F.transform(
            at["counts"],
            lambda c, k: c + F.when(k + 1 == enter, 1).otherwise(0) - F.when(k + 1 == leave, 1).otherwise(0),
        )
        entropy = F.when(at["seen"] + 1 >= w, F.lit(math.log2(w)) - total / w).otherwise(-1.0)
        return F.struct(
            counts.alias("counts"),
            total.alias("total"),
            (at["seen"] + 1).alias("seen"),
            F.greatest(at["peak"], entropy).alias("peak"),
        )

    zero = F.struct(
        F.array_repeat(F.lit(0), len(kind.alphabet)).alias("counts"),
        F.lit(0.0).alias("total"),
        F.lit(0).alias("seen"),
        F.lit(-1.0).alias("peak"),
    )
    return F.when(
        F.char_length(value) >= w, F.reduce(pairs, zero, step, lambda at: at["peak"])
    ).otherwise(-1.0)


NAMED = "array<struct<start:int,place:int,end:int,kind:string>>"


def _named(spans: Column, place: int, kind: str) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(place).alias("place"), s["end"].alias("end"), F.lit(kind).alias("kind")
        ),
    )


def base_spans(text: Column) -> Column:
    """Spans by pattern, sorted by start, then kind.

    An assignment is matched first and its value measured after: a match whose
    value is too short takes its text with it. The other two have one alphabet
    to their end, so that the length can be part of the pattern.
    """
    value = lambda s: F.regexp_extract(s["value"], "^" + ASSIGN, 2)
    assign = F.filter(matches(text, ASSIGN), lambda s: F.char_length(value(s)) >= 8)
    empty = F.array().cast(NAMED)
    runs = F.concat(_named(matches(text, ACCESS), 1, "access"), _named(matches(text, HEX), 2, "hex"))
    return F.sort_array(
        F.concat(
            F.when(F.regexp_like(text, F.lit(ASSIGN_GATE)), _named(assign, 0, "assign")).otherwise(empty),
            F.when(F.regexp_like(text, F.lit(RUN_GATE)), runs).otherwise(empty),
        )
    )


def _reaches(kind: EntropyClass):
    return lambda s: peak_entropy(s["value"], kind) >= kind.limit


def blanked(text: Column, spans: Column) -> Column:
    """``text`` with a space for each character of the sorted ``spans``."""

    def step(done: Column, s: Column) -> Column:
        begin = F.greatest(s["start"], done["at"])
        between = F.substring(text, done["at"] + 1, begin - done["at"])
        return F.when(
            s["end"] > done["at"],
            F.struct(s["end"].alias("at"), F.concat(done["out"], between, F.repeat(F.lit(" "), s["end"] - begin)).alias("out")),
        ).otherwise(done)

    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.char_length(text)))
    return F.when(F.size(spans) > 0, F.reduce(spans, zero, step, rest)).otherwise(text)


def entropy_spans(
    text: Column,
    base: Column,
    classes: tuple[EntropyClass, ...] = CLASSES,
    allowed: tuple[str, ...] = ALLOWED,
    allowed_parts: tuple[tuple[str, int], ...] = ALLOWED_PARTS,
) -> Column:
    """Spans of candidates with a window of high entropy: what the spans of ``base`` and
    the allowed parts leave of a run is a candidate of its own."""

    def listed(value: Column) -> Column:
        out = F.lit(False)
        for pattern in allowed:
            out = out | F.regexp_like(value, F.lit(pattern))
        return out

    left = text
    for pattern, length in allowed_parts:
        left = F.regexp_replace(left, pattern, " " * length)
    left = blanked(left, base)
    found = F.array().cast(NAMED)
    for k, kind in enumerate(classes):
        spans = F.filter(matches(left, kind.pattern), lambda s: ~listed(s["value"]))
        found = F.concat(found, _named(F.filter(spans, _reaches(kind)), len(KINDS) + k, kind.name))
    shortest = min((kind.window for kind in classes), default=0)
    if shortest < 16:
        return F.sort_array(found)
    return F.when(F.regexp_like(text, F.lit(RUN_GATE)), F.sort_array(found)).otherwise(F.array().cast(NAMED))


def shown(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def with_spans(df, text_col: str = "text", base_col: str = "base_spans", spans_col: str = "spans"):
    """``df`` with the spans by pattern, and all spans, as arrays of (start, place, end, kind).

    Columns of these names are replaced.
    """
    kept = df.drop(base_col, spans_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    based = kept.withColumn(base_col, base_spans(text))
    return based.withColumn(
        spans_col, F.sort_array(F.concat(F.col(base_col), entropy_spans(text, F.col(base_col))))
    )


def redacted(text: Column, spans: Column, instead: str = "[SECRET]") -> Column:
    """``text`` with each stretch of overlapping spans replaced by ``instead``."""

    def step(done: Column, s: Column) -> Column:
        begin = F.greatest(s["start"], done["at"])
        between = F.substring(text, done["at"] + 1, begin - done["at"])
        fresh = F.concat(done["out"], between, F.when(s["start"] >= done["at"], F.lit(instead)).otherwise(""))
        return F.struct(
            F.greatest(s["end"], done["at"]).alias("at"),
            F.when(s["end"] > done["at"], fresh).otherwise(done["out"]).alias("out"),
        )

    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.char_length(text)))
    return F.when(F.size(spans) > 0, F.reduce(spans, zero, step, rest)).otherwise(text)


def digests(df, id_col: str = "doc_id"):
    """Counts by kind, digest of the spans by pattern, and all spans, from :func:`with_spans`."""
    count = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long")
    return df.select(
        id_col,
        *[count(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(shown(F.col("base_spans")), 256).alias("base_sha256"),
        shown(F.col("spans")).alias("spans"),
    )
