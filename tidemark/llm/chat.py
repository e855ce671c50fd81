"""Chat formatting by a declarative template, in DataFrame functions only.

A finite-state machine over the roles validates the order of turns. Each turn
becomes three segments (opening mark, text, closing mark), each with a loss flag.
Control strings inside texts get an escape character after their first one, and
the escape character is doubled, so that the marks of the formatted text are the
template's own and the texts can be read back.

A conversation is one row, whose turns one task holds: its formatted text is one
string. Turns are sorted by number, then role, then text; a NULL number comes
first, a NULL role or text is empty. Repeated rows are turns of their own. Roles
without marks of their own are written between the marks for other roles; the
machine calls them invalid, as it does a conversation without turns.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

ESCAPE = "\\"


@dataclass(frozen=True)
class Marks:
    """What stands before and after a turn's text, and whether the text is learned."""

    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Marks by role, marks around other roles and their turns, and the machine.

    ``controls`` are the strings that no text may contain. Each mark must contain
    one, none may contain the escape character, and no two may overlap.
    """

    roles: dict[str, Marks]
    other: Marks
    after_role: str
    controls: tuple[str, ...]
    moves: dict[tuple[str, str], str]
    start: str = "start"
    accepted: frozenset[str] = field(default_factory=frozenset)

    def __post_init__(self) -> None:
        for mark in (*self.roles.values(), self.other):
            for text in (mark.open, mark.close):
                if not any(c in text for c in self.controls):
                    raise ValueError(f"no control string in the mark {text!r}")
        for a in self.controls:
            if len(a) < 2 or ESCAPE in a:
                raise ValueError(f"unfit control string {a!r}")
            for b in self.controls:
                if any(a.endswith(b[:k]) for k in range(1, len(b))):
                    raise ValueError(f"control strings {a!r} and {b!r} overlap")


INSTRUCTIONS = Template(
    roles={
        "system": Marks("<<SYS>>\n", "\n<</SYS>>\n"),
        "user": Marks("[INST] ", " [/INST]"),
        "assistant": Marks("<s>", "</s>", loss=True),
    },
    other=Marks("[ROLE]", "[/TURN]"),
    after_role="[/ROLE]",
    controls=("<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "[ROLE]", "[/ROLE]", "[/TURN]"),
    moves={
        ("start", "system"): "system",
        ("start", "user"): "user",
        ("system", "user"): "user",
        ("user", "assistant"): "assistant",
        ("assistant", "user"): "user",
    },
    accepted=frozenset({"assistant"}),
)


def escaped(text: Column, template: Template) -> Column:
    inside = "|".join(f"(?<={re.escape(c[0])})(?={re.escape(c[1:])})" for c in template.controls)
    doubled = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    return F.regexp_replace(doubled, inside, ESCAPE * 2)


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def _lookup(values: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), key)


def formatted(
    conversations: DataFrame,
    template: Template = INSTRUCTIONS,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Per conversation: id, ``valid``, ``error_turn``, ``segments``, ``formatted``.

    ``error_turn`` is the place, from 0, of the first turn that the machine refuses;
    the number of turns if it only ended too early; NULL if valid. ``segments`` are
    structs of ``text`` and ``loss``; ``formatted`` is their texts together.
    """
    turn = F.struct(
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    grouped = conversations.groupBy(F.col(id_col).alias("id")).agg(
        F.sort_array(F.collect_list(turn)).alias("turns")
    )

    def segments(t: Column) -> Column:
        opens = {role: marks.open for role, marks in template.roles.items()}
        closes = {role: marks.close for role, marks in template.roles.items()}
        learned = [role for role, marks in template.roles.items() if marks.loss]
        named = F.concat(F.lit(template.other.open), escaped(t["role"], template), F.lit(template.after_role))
        loss = F.when(t["role"].isin(*template.roles), t["role"].isin(*learned) if learned else F.lit(False))
        return F.array(
            F.struct(F.coalesce(_lookup(opens, t["role"]), named).alias("text"), F.lit(False).alias("loss")),
            F.struct(escaped(t["text"], template).alias("text"), loss.otherwise(F.lit(template.other.loss)).alias("loss")),
            F.struct(
                F.coalesce(_lookup(closes, t["role"]), F.lit(template.other.close)).alias("text"),
                F.lit(False).alias("loss"),
            ),
        )

    moves = {f"{state}\n{role}": to for (state, role), to in template.moves.items()}

    def move(at: Column, t: Column) -> Column:
        to = _lookup(moves, F.concat(at["state"], F.lit("\n"), t["role"]))
        return F.struct(
            F.coalesce(to, F.lit("")).alias("state"),
            (at["place"] + 1).alias("place"),
            F.when(at["error"].isNotNull(), at["error"]).when(to.isNull(), at["place"]).alias("error"),
        )

    begin = F.struct(
        F.lit(template.start).alias("state"), F.lit(0).alias("place"), F.lit(None).cast("int").alias("error")
    )
    ended = F.reduce("turns", begin, move)
    walked = grouped.select(
        "id", ended.alias("ended"), F.flatten(F.transform("turns", segments)).alias("segments")
    )
    error = F.when(F.col("ended.error").isNotNull(), F.col("ended.error")).when(
        ~F.col("ended.state").isin(*template.accepted), F.col("ended.place")
    )
    return walked.select(
        F.col("id").alias(id_col),
        error.isNull().alias("valid"),
        error.alias("error_turn"),
        "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
    )


def read_back(text: Column, template: Template = INSTRUCTIONS) -> Column:
    """Array of (role, text) read from a formatted text alone."""
    every = {**template.roles, None: template.other}
    quoted = lambda s: re.escape(s).replace("\\\n", "\n")
    pattern = "(?s)" + "|".join(f"{quoted(m.open)}.*?{quoted(m.close)}" for m in every.values())

    def turn(t: Column) -> Column:
        body = lambda m: F.substring(t, F.lit(len(m.open) + 1), F.char_length(t) - len(m.open) - len(m.close))
        part = lambda k: F.try_element_at(F.split(body(template.other), quoted(template.after_role), 2), F.lit(k))
        out = F.struct(unescaped(part(1)).alias("role"), unescaped(part(2)).alias("text"))
        for role, marks in template.roles.items():
            own = F.struct(F.lit(role).alias("role"), unescaped(body(marks)).alias("text"))
            out = F.when(F.startswith(t, F.lit(marks.open)), own).otherwise(out)
        return out

    return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), turn)


def digests(chats: DataFrame, template: Template = INSTRUCTIONS, id_col: str = "conv_id") -> DataFrame:
    """What the formatted output holds, read back from it."""
    read = chats.select(
        id_col,
        "valid",
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        read_back(F.col("formatted"), template).alias("turns"),
        F.array_join(
            F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"])), ""
        ).alias("learned"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        id_col,
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned"), 256).alias("loss_sha256"),
        "formatted_chars",
        "valid",
    )
