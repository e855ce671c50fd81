"""Repair of a conversation's structure by its cheapest edits, with an audit of them.

A conversation is to read ``(system? (user assistant)+)?`` in its roles' initials.
Edits, in the order of turns: keep a turn (``K``, 0), give it the role user or assistant
(``R``, 2), delete it (``D``, 3; a blank or repeated turn must go), insert an empty user
or assistant turn (``I``, 2); a truncated turn that stays adds 1. Of the cheapest edits
those with the ASCII-least audit, the string of their initials, are taken.

The search is a dynamic programme over what stands at the end of the repaired part:
nothing, system, user or assistant. Each holds its cost and its audit so far, as a node
that extends its parent's audit: prefixes are shared, never copied. Nodes know their
ancestors 2**k steps up and a rolling hash of their whole audit. On a tie the longest
common prefix of two audits is found by binary search over hashes of ancestors, is
compared letter by letter down to the node that both share (so that equal hashes
of different audits can't mislead), and the next letter decides.

Spark deals the turns out by ranges of (conversation, turn, role), so that a long
conversation is spread over tasks. A task cuts its rows into pieces and solves each for
every state in which it may begin; one task per conversation then joins solved
pieces, in order, with the same nodes, and hashes the repaired text along the way. It
holds one piece and the audits.

A first fault is counted per turn: blank (no character but white space), duplicate
(role and text seen before in the conversation), truncated (last such character not one
of ``.!?``). Turns are taken by turn, NULL first, then role, then text; NULL role and
text are one space; a role that begins with none of ``s``, ``u``, ``a``, an empty one
too, can't be kept. Rows without a conversation id form one. Of equal rows all but one
are duplicates. Other columns are ignored; no rows give no conversations.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import MOST_IDS, in_arrow
from tidemark.workspace import pin

#: Rows, and characters, that make a piece.
PIECE, PIECE_CHARS = 512, 1 << 20
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED = 1
#: What stands at the end of the repaired part; ``BEGIN`` is a conversation that begins.
NOTHING, SYSTEM, USER, ASSISTANT, BEGIN = "esuab"
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: State after a turn of a user or an assistant.
NEXT = {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
SPACES = " \t\n\x0b\x0c\r"
MOD, BASE = (1 << 61) - 1, 0x1F3D5B79A2C4E681 % ((1 << 61) - 1)


class Prefix:
    """An audit: ``text`` behind the audit of ``parent``."""

    __slots__ = ("parent", "text", "depth", "hash", "up")

    def __init__(self, parent: Prefix | None, text: str):
        self.parent, self.text = parent, text
        if parent is None:
            self.depth, self.hash, self.up = 0, 0, ()
            return
        self.depth = parent.depth + len(text)
        self.hash = rolled(parent.hash, text)
        up, k = [parent], 0
        while k < len(up[k].up):
            up.append(up[k].up[k])
            k += 1
        self.up = up

    def at(self, depth: int) -> Prefix:
        """The node that holds the last letter of the first ``depth``."""
        node = self
        for k in range(len(node.up) - 1, -1, -1):
            if k < len(node.up) and node.up[k].depth >= depth:
                node = node.up[k]
        return node

    def hash_at(self, depth: int) -> int:
        node = self.at(depth)
        if node.depth == depth:
            return node.hash
        return rolled(node.parent.hash, node.text[: depth - node.parent.depth])

    def letter(self, place: int) -> str:
        """Letter ``place``, empty at the end."""
        if place == self.depth:
            return ""
        node = self.at(place + 1)
        return node.text[place - node.parent.depth]

    def spelled(self) -> str:
        parts, node = [], self
        while node.parent is not None:
            parts.append(node.text)
            node = node.parent
        return "".join(reversed(parts))


def rolled(start: int, text: str) -> int:
    for c in text:
        start = (start * BASE + ord(c)) % MOD
    return start


def same(x: Prefix, y: Prefix, depth: int) -> bool:
    """Whether the first ``depth`` letters agree, by the letters themselves."""
    a, b = x.at(depth), y.at(depth)
    while a is not b and depth:
        low = max(a.parent.depth, b.parent.depth)
        if a.text[low - a.parent.depth : depth - a.parent.depth] != b.text[low - b.parent.depth : depth - b.parent.depth]:
            return False
        depth = low
        a = a.parent if a.parent.depth == depth else a
        b = b.parent if b.parent.depth == depth else b
    return True


def less(x: Prefix, y: Prefix) -> bool:
    """Whether ``x`` is ASCII-less than ``y``."""
    if x is y:
        return False
    if x.parent is y.parent:
        return x.text < y.text
    low, high = 0, min(x.depth, y.depth)
    while low < high:
        middle = (low + high + 1) // 2
        if x.hash_at(middle) == y.hash_at(middle):
            low = middle
        else:
            high = middle - 1
    if not same(x, y, low):
        return x.spelled() < y.spelled()
    return x.letter(low) < y.letter(low)


@dataclass
class Turn:
    role: str
    text: str
    must_go: bool = False
    truncated: bool = False


#: Cost and audit of the best edits that lead to a state.
States = dict[str, tuple[int, Prefix]]


def _offer(states: States, state: str, cost: int, parent: Prefix, text: str) -> None:
    held = states.get(state)
    if held is None or cost < held[0]:
        states[state] = cost, Prefix(parent, text)
    elif cost == held[0]:
        node = Prefix(parent, text)
        if less(node, held[1]):
            states[state] = cost, node


def _inserted(states: States) -> None:
    """Reach states by inserted turns; more than two in a row never pay."""
    for before in (NOTHING, SYSTEM, ASSISTANT, USER):
        if before in states:
            cost, node = states[before]
            _offer(states, NEXT[before], cost + COST[INSERT], node, INSERT)


def solved(turns: list[Turn], entry: str) -> States:
    """The best edits of ``turns`` by the state in which they end, from state ``entry``."""
    states: States = {NOTHING if entry == BEGIN else entry: (0, Prefix(None, ""))}
    if entry == BEGIN:
        _inserted(states)
    for turn in turns:
        after: States = {}
        stays = TRUNCATED if turn.truncated else 0
        for state, (cost, node) in states.items():
            _offer(after, state, cost + COST[DELETE], node, DELETE)
            if turn.must_go:
                continue
            spoken = NEXT[state]
            if turn.role[:1] == spoken:
                _offer(after, spoken, cost + COST[KEEP] + stays, node, KEEP)
            else:
                _offer(after, spoken, cost + COST[REROLE] + stays, node, REROLE)
            if state == NOTHING and turn.role[:1] == SYSTEM:
                _offer(after, SYSTEM, cost + COST[KEEP] + stays, node, KEEP)
        _inserted(after)
        states = after
    return states


def edited(turns: list[tuple[str, str]], entry: str, audit: str) -> Iterator[tuple[str, str]]:
    """Role and text of the turns that ``audit`` leaves of ``turns``."""
    state, place = NOTHING if entry == BEGIN else entry, 0
    for edit in audit:
        role, text = ("", "") if edit == INSERT else turns[place]
        place += edit != INSERT
        if edit == DELETE:
            continue
        state = role[:1] if edit == KEEP else NEXT[state]
        yield role if edit == KEEP else ROLES[state], text


FAULTS = ("blank", "duplicate", "truncated")
SOLVED = "array<struct<entry:string,exit:string,cost:long,audit:string>>"
COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")
PIECES = (
    f"seq long, begins boolean, roles array<string>, texts array<string>, solved {SOLVED}, "
    "first_turn long, last_turn long, " + ", ".join(f"{c} long" for c in COUNTS)
)


@dataclass
class Piece:
    """Consecutive turns of a conversation, with what its faults are."""

    begins: bool | None = None
    turns: list[Turn] = field(default_factory=list)
    chars: int = 0
    counts: dict[str, int] = field(default_factory=lambda: dict.fromkeys(COUNTS, 0))
    first_turn: int | None = None
    last_turn: int | None = None

    def add(self, turn: int | None, role: str, text: str, repeated: bool) -> None:
        shown = text.strip(SPACES)
        blank = not shown
        truncated = not (blank or repeated) and shown[-1] not in ".!?"
        for name, is_so in zip(FAULTS, (blank, repeated and not blank, truncated), strict=True):
            self.counts[name] += is_so
        if self.turns:
            self.counts["illegal"] += illegal(self.turns[-1].role, role)
        if turn is not None:
            self.counts["turns"] += turn != self.last_turn
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        self.turns.append(Turn(role, text, blank or repeated, truncated))
        self.chars += len(text)

    def row(self, seq: int) -> dict:
        entries = (BEGIN,) if self.begins else (NOTHING, SYSTEM, USER, ASSISTANT)
        entries += (BEGIN,) if self.begins is None else ()
        return {
            "seq": seq,
            "begins": bool(self.begins),
            "roles": [t.role for t in self.turns],
            "texts": [t.text for t in self.turns],
            "solved": [
                {"entry": entry, "exit": state, "cost": cost, "audit": node.spelled()}
                for entry in entries
                for state, (cost, node) in solved(self.turns, entry).items()
            ],
            "first_turn": self.first_turn,
            "last_turn": self.last_turn,
            **self.counts,
        }


def illegal(before: str, after: str) -> bool:
    return before[:1] + after[:1] not in ("su", "ua", "au")


def _cut(rows: Iterator[tuple]) -> Iterator[tuple[object, Piece]]:
    """Pieces of sorted rows of (conversation, turn, role, text, later, present)."""
    piece, of, last, any_ = Piece(), None, None, False
    for row in rows:
        conv, turn, role, text, later, present = row
        if any_ and conv != of:
            yield of, piece
            piece, last = Piece(begins=True), None
        elif len(piece.turns) >= PIECE or piece.chars >= PIECE_CHARS:
            yield of, piece
            piece = Piece(begins=False)
        of, any_ = conv, True
        if present:
            piece.add(turn, role, text, later or row == last)
            last = row
    if any_:
        yield of, piece


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _batches(rows: Iterator[dict], schema: pa.Schema, at_once: int = 512) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= at_once:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def faulty_turns(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, present: Column | None):
    """``conv``, ``turn``, ``role``, ``text``, ``later`` (said in an earlier turn), ``present``, written once.

    A row that is not ``present`` only names its conversation.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    turns = conversations.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).cast("long").alias("turn"),
        blank(role_col).alias("role"),
        blank(text_col).alias("text"),
        (F.lit(True) if present is None else F.coalesce(present, F.lit(False))).alias("present"),
    ).withColumn("said", F.sha2("text", 256))
    turns = pin(turns, "turns")
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    again = (
        turns.where("present").groupBy(F.col("conv").alias("of"), F.col("role").alias("by"), F.col("said").alias("what"))
        .agg(F.count("*").alias("times"), F.min(place).alias("first")).where("times > 1").drop("times")
    )
    again = pin(again, "repeated")
    few = again.limit(MOST_IDS // 10 + 1).count() <= MOST_IDS // 10
    on = F.col("conv").eqNullSafe(F.col("of")) & (F.col("role") == F.col("by")) & (F.col("said") == F.col("what"))
    joined = turns.join(F.broadcast(again) if few else again, on, "left")
    return joined.select("conv", "turn", "role", "text", F.coalesce(place > F.col("first"), F.lit(False)).alias("later"), "present")


def pieces(turns: DataFrame) -> DataFrame:
    """Solved pieces of the conversations of ``faulty_turns``; ``seq`` follows the order of turns."""
    spark = turns.sparkSession
    kind = turns.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return
        number = TaskContext.get().partitionId() << 33

        def rows():
            yield first
            yield from batches

        out = ({"conv": conv, **piece.row(number + i)} for i, (conv, piece) in enumerate(_cut(_rows(rows()))))
        yield from _batches(out, _arrow(first.schema.field(0).type))

    dealt = turns.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "conv", "turn", "role")
    return in_arrow(dealt.sortWithinPartitions("conv", "turn", "role", "text"), run, f"conv {kind}, {PIECES}")


def _arrow(conv: pa.DataType) -> pa.Schema:
    strings, longs = pa.list_(pa.string()), pa.int64()
    row = pa.struct([("entry", pa.string()), ("exit", pa.string()), ("cost", longs), ("audit", pa.string())])
    fields = [("conv", conv), ("seq", longs), ("begins", pa.bool_()), ("roles", strings), ("texts", strings)]
    fields += [("solved", pa.list_(row)), ("first_turn", longs), ("last_turn", longs)]
    return pa.schema(fields + [(c, longs) for c in COUNTS])


class Conversation:
    """Pieces joined in order: the best edits by state, with the digest of what they leave."""

    def __init__(self):
        #: By state: cost, audit, digest so far, whether any turn is left.
        self.states = {BEGIN: (0, Prefix(None, ""), hashlib.sha256(), False)}
        self.counts = dict.fromkeys(COUNTS, 0)
        self.pending: dict | None = None
        self.least = self.most = self.role = None
        self.path: dict[Prefix, tuple] = {}

    def add(self, piece: dict) -> None:
        self._advance()
        for name in COUNTS:
            self.counts[name] += piece[name]
        if piece["first_turn"] is not None:
            self.counts["turns"] -= piece["first_turn"] == self.most
            self.least = piece["first_turn"] if self.least is None else self.least
            self.most = piece["last_turn"]
        if piece["roles"]:
            if self.role is not None:
                self.counts["illegal"] += illegal(self.role, piece["roles"][0])
            self.role = piece["roles"][-1]
        self.pending = piece

    def _best(self, exits) -> dict[str, tuple]:
        """By exit: cost, audit, entry and own audit of the best way through the pending piece."""
        best: dict[str, tuple] = {}
        for way in self.pending["solved"]:
            if way["entry"] not in self.states or way["exit"] not in exits:
                continue
            cost, before = self.states[way["entry"]][:2]
            cost += way["cost"]
            held = best.get(way["exit"])
            if held is None or cost <= held[0]:
                node = Prefix(before, way["audit"]) if way["audit"] else before
                if held is None or cost < held[0] or less(node, held[1]):
                    best[way["exit"]] = cost, node, way["entry"], way["audit"]
        return best

    def _through(self, best: dict[str, tuple]) -> None:
        turns = list(zip(self.pending["roles"], self.pending["texts"], strict=True))
        states = {}
        for state, (cost, node, entry, audit) in best.items():
            _, _, digest, any_ = self.states[entry]
            digest = digest.copy()
            for role, text in edited(turns, entry, audit):
                digest.update(f"{chr(10) if any_ else ''}{role}:{text}".encode())
                any_ = True
            states[state] = cost, node, digest, any_
        self.states, self.pending = states, None

    def _advance(self) -> None:
        if self.pending is not None:
            self._through(self._best((NOTHING, SYSTEM, USER, ASSISTANT)))

    def result(self) -> dict:
        best = self._best((NOTHING, ASSISTANT))
        end = NOTHING
        if ASSISTANT in best and NOTHING in best:
            (a, x), (b, y) = best[ASSISTANT][:2], best[NOTHING][:2]
            end = ASSISTANT if a < b or a == b and less(x, y) else NOTHING
        elif ASSISTANT in best:
            end = ASSISTANT
        self._through({end: best[end]})
        cost, node, digest, _ = self.states[end]
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.counts["turns"]
        return {
            "gaps": gaps,
            **{c: self.counts[c] for c in COUNTS[:-1]},
            "cost": cost,
            "audit": node.spelled(),
            "repaired_sha256": digest.hexdigest(),
        }


RESULT = ("gaps", *COUNTS[:-1], "cost")


def joined(parts: DataFrame, conv_col: str) -> DataFrame:
    """One row per conversation from its ``pieces``."""
    kind = parts.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return
        schema = pa.schema(
            [("conv", first.schema.field(0).type)]
            + [(c, pa.int64()) for c in RESULT]
            + [("audit", pa.string()), ("repaired_sha256", pa.string())]
        )

        def rows():
            of, conversation, batch = None, None, first
            while batch is not None:
                for i in range(batch.num_rows):
                    piece = batch.slice(i, 1).to_pylist()[0]
                    if conversation is None or piece["conv"] != of:
                        if conversation is not None:
                            yield {"conv": of, **conversation.result()}
                        of, conversation = piece["conv"], Conversation()
                    conversation.add(piece)
                batch = next(batches, None)
            yield {"conv": of, **conversation.result()}

        yield from _batches(rows(), schema)

    dealt = parts.repartition("conv").sortWithinPartitions("conv", "seq")
    longs = ", ".join(f"{c} long" for c in RESULT)
    found = in_arrow(dealt, run, f"conv {kind}, {longs}, audit string, repaired_sha256 string")
    return found.withColumnRenamed("conv", conv_col)


def repaired(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    present: Column | None = None,
) -> DataFrame:
    """Per conversation: its faults, and cost, audit and digest of its repair.

    ``gaps`` (turn numbers that are missing between the least and the greatest),
    ``blank``, ``duplicate``, ``truncated``, ``illegal`` (neighbours whose roles may not
    follow each other), ``cost``, ``audit``, ``repaired_sha256`` (of ``role:text``, a line
    each). Rows that are not ``present`` are lost turns: their conversation is listed
    even if nothing of it is left.
    """
    turns = faulty_turns(conversations, conv_col, turn_col, role_col, text_col, present)
    return joined(pieces(turns), conv_col)
