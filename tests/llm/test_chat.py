import hashlib
import random

import pytest

from tidemark.llm import chat as C

T = C.INSTRUCTIONS


def frame(spark, rows, extra=""):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def conversations():
    rng = random.Random(3)
    pieces = [*T.controls, "\\", "\\\\", "<", ">", "[", "]", "/", "INST]", "</", "s>", " ", "\n", "é", "日", "ok", "$1", ""]
    out = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    for conv in range(150):
        for turn in range(rng.randint(1, 6)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", "[/ROLE]", "a\nb", None])
            text = None if rng.random() < 0.05 else "".join(rng.choice(pieces) for _ in range(rng.randint(0, 9)))
            out.append((conv, turn, role, text))
    return out


def test_texts_come_back(spark):
    rows = conversations()
    got = {r["conv_id"]: r for r in C.digests(C.formatted(frame(spark, rows))).collect()}
    assert len(got) == len({r[0] for r in rows})
    for conv, row in got.items():
        turns = [(r or "", t or "") for c, _, r, t in sorted(rows, key=lambda r: r[:2]) if c == conv]
        learned = "".join(t for r, t in turns if r == "assistant")
        assert row["n_turns"] == len(turns)
        assert row["turns_sha256"] == sha("".join(f"{r}\n{t}\n" for r, t in turns))
        assert (row["loss_chars"], row["loss_sha256"]) == (len(learned), sha(learned))


def test_marks_are_the_templates_own(spark):
    for row in C.formatted(frame(spark, conversations())).collect():
        assert row["formatted"] == "".join(s["text"] for s in row["segments"])
        bodies = [s["text"] for s in row["segments"][1::3]]
        assert not [c for c in T.controls for b in bodies if c in b]


def test_machine(spark):
    def verdict(*roles):
        rows = [(1, i, r, "x") for i, r in enumerate(roles)]
        row = C.formatted(frame(spark, rows)).first()
        return row["valid"], row["error_turn"]

    assert verdict("user", "assistant") == (True, None)
    assert verdict("system", "user", "assistant", "user", "assistant") == (True, None)
    assert verdict("user") == (False, 1)
    assert verdict("assistant", "user") == (False, 0)
    assert verdict("user", "system", "assistant") == (False, 1)
    assert verdict("user", "tool", "assistant") == (False, 1)


def test_nulls_ties_repeats_and_nothing(spark):
    rows = [(None, 0, "user", "a"), (2, None, "user", "first"), (2, 0, "assistant", "b"), (2, 0, "assistant", "a"), (2, 0, "assistant", "a")]
    got = {r["conv_id"]: r["formatted"] for r in C.formatted(frame(spark, rows)).collect()}
    assert got == {
        None: "[INST] a [/INST]",
        2: "[INST] first [/INST]<s>a</s><s>a</s><s>b</s>",
    }
    assert C.digests(C.formatted(frame(spark, []))).count() == 0


def test_long_text_and_extra_columns(spark):
    long = "a\\<s>" * 200_000
    df = frame(spark, [(1, 0, "user", "q"), (1, 1, "assistant", long)]).selectExpr("*", "1 as valid", "2 as formatted")
    row = C.digests(C.formatted(df)).first()
    assert row["loss_sha256"] == sha(long) and row["n_turns"] == 2


def test_unfit_templates_are_refused():
    with pytest.raises(ValueError):
        C.Template({}, C.Marks("<a>", "b"), "<a>", ("<a>",), {})
    with pytest.raises(ValueError):
        C.Template({}, C.Marks("<a>", "><b"), "<a>", ("<a>", "><b"), {})
