import hashlib
import random
import re
from functools import lru_cache

import pytest

from tidemark.llm import repair as R
from tidemark.llm.queries import damaged_turns

FIELDS = "conv_id long, turn long, role string, text string"


def brute(turns):
    """Least (cost, audit, text) over all edits of (role, text, must_go, truncated)."""

    @lru_cache(None)
    def best(i, state, inserted):
        found = [(0, "", ())] if i == len(turns) and state in "ea" else []

        def add(cost, letter, rest, said=()):
            if rest:
                found.append((cost + rest[0], letter + rest[1], said + rest[2]))

        spoken = "a" if state == "u" else "u"
        name = {"u": "user", "a": "assistant"}[spoken]
        if inserted < 3:
            add(2, "I", best(i, spoken, inserted + 1), (f"{name}:",))
        if i < len(turns):
            role, text, must_go, truncated = turns[i]
            add(3, "D", best(i + 1, state, 0))
            if not must_go:
                late = int(truncated)
                if role[:1] == spoken:
                    add(late, "K", best(i + 1, spoken, 0), (f"{role}:{text}",))
                if role[:1] == "s" and state == "e":
                    add(late, "K", best(i + 1, "s", 0), (f"{role}:{text}",))
                add(2 + late, "R", best(i + 1, spoken, 0), (f"{name}:{text}",))
        return min(found, default=None)

    cost, audit, said = best(0, "e", 0)
    return cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest()


def brute_row(rows):
    rows = sorted(((t, r or " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, turns, blank, dup, cut = set(), [], 0, 0, 0
    for _, role, text in rows:
        empty = not re.search(r"[^\x20\x09-\x0D]", text)
        again = not empty and (role, text) in seen
        late = not (empty or again) and not re.search(r"[.!?][\x20\x09-\x0D]*\Z", text)
        seen.add((role, text))
        blank, dup, cut = blank + empty, dup + again, cut + late
        turns.append((role, text, empty or again, late))
    wrong = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False))
    known = [t for t, _, _ in rows if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    cost, audit, digest = brute(tuple(turns))
    return gaps, blank, dup, cut, wrong, cost, audit, digest


def found(df):
    return {r["conv_id"]: tuple(r)[1:] for r in df.collect()}


def some(rng, n):
    roles = ["user", "assistant", "system", "tool", "", None, "User"]
    texts = ["Yes.", "no", "", " \t", None, "Why?", "é!", "a\x1c", "ok. \n"]
    weights = [6, 6, 2, 1, 1, 1, 1]
    turn = lambda: rng.choice([None, *range(n + 2)])
    fresh = lambda: f"{rng.random()}" + rng.choice(".!?;")
    return [
        (turn(), rng.choices(roles, weights)[0], rng.choice(texts) if rng.random() < 0.5 else fresh()) for _ in range(n)
    ]


@pytest.mark.parametrize("piece", [512, 2])
def test_equals_brute_force(spark, monkeypatch, piece):
    rng = random.Random(piece)
    chats = {i: some(rng, rng.randint(1, 9)) for i in range(150)} | {None: some(rng, 6)}
    rows = [(c, *t) for c, turns in chats.items() for t in turns]
    expected = {c: brute_row(turns) for c, turns in chats.items()}
    df = spark.createDataFrame(rows, FIELDS).repartition(7)
    if piece == 512:
        assert found(R.repaired(df)) == expected
        return
    # Pieces of two turns, in one process: every state is joined to every other.
    monkeypatch.setattr(R, "PIECE", piece)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    for conv, turns in chats.items():
        said, flat = {}, []
        plain = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in turns), key=order)
        for t, r, x in plain:
            said.setdefault((r, x), t)
            flat.append((conv, t, r, x, t != said[r, x], True))
        chat = R.Conversation()
        for i, (_, part) in enumerate(R._cut(iter(flat))):
            chat.add(part.row(i))
        assert tuple(chat.result().values()) == expected[conv]


def test_long_conversation_over_many_tasks(spark):
    rng = random.Random(3)
    turns = [(i // 2, rng.choice(["user", "assistant", "system"]), rng.choice(["a.", "b", "c!", "", str(i) + "?"])) for i in range(700)]
    rows = [(1, *t) for t in turns] + [(2, 0, "user", "x" * 300_000), (2, 1, "assistant", "y.")]
    df = spark.createDataFrame(rows, FIELDS).repartition(5)
    assert R.pieces(R.faulty_turns(df, "conv_id", "turn", "role", "text", None)).where("conv = 1").count() > 2
    result = found(R.repaired(df))
    import sys

    sys.setrecursionlimit(20_000)
    assert result[1] == brute_row(turns)
    assert result[2][4:7] == (0, 1, "KK")


def test_lost_turns_no_rows_and_other_columns(spark):
    rows = [(1, 0, "user", "hi.", False, "x"), (2, 0, "user", "hi.", True, "x"), (2, 1, "assistant", "ho.", None, "y")]
    df = spark.createDataFrame(rows, FIELDS + ", there boolean, conv string")
    from pyspark.sql import functions as F

    result = found(R.repaired(df, present=F.col("there")))
    nothing = hashlib.sha256(b"").hexdigest()
    assert result[1] == (0, 0, 0, 0, 0, 0, "", nothing)
    assert result[2] == (0, 0, 0, 0, 0, 2, "KI", hashlib.sha256(b"user:hi.\nassistant:").hexdigest())
    assert found(R.repaired(df.limit(0))) == {}


def test_damage(spark):
    import zlib

    rows = [(i, j, "assistant", "a. b!") for i in range(40) for j in (0, None)]
    out = damaged_turns(spark.createDataFrame(rows, FIELDS)).collect()
    for i, j, role, text in rows:
        kind = zlib.crc32(f"{i}:{' ' if j is None else j}".encode()) % 20
        own = [tuple(r)[2:5] for r in out if (r["conv_id"], r["turn"]) == (i, j)]
        expected = ("user" if kind == 4 else role, {1: "", 2: "a b"}.get(kind, text), kind != 0)
        assert own == [expected] * (2 if kind == 3 else 1)


def chain(text):
    node = R.Prefix(None, "")
    for c in text:
        node = R.Prefix(node, c)
    return node


def test_prefixes_compare_as_their_strings(monkeypatch):
    rng = random.Random(5)
    root = R.Prefix(None, "")
    nodes = [root]
    for _ in range(400):
        nodes.append(R.Prefix(rng.choice(nodes[-30:]), "".join(rng.choices("DIK", k=rng.randint(1, 3)))))
    pairs = [(rng.choice(nodes), rng.choice(nodes)) for _ in range(2000)]
    pairs += [(chain("KKKKKKKD"), chain("KKKKKKKI")), (chain("KKK"), chain("KKKD")), (chain("KD"), chain("KD"))]
    for x, y in pairs:
        assert R.less(x, y) == (x.spelled() < y.spelled())
    # Every hash collides: the letters decide all the same.
    monkeypatch.setattr(R, "rolled", lambda start, text: 0)
    for x, y in [(chain("KDKK"), chain("KIKD")), (chain("IKKK"), chain("DKKK")), (chain("KKR"), chain("KKD"))]:
        assert R.less(x, y) == (x.spelled() < y.spelled())
