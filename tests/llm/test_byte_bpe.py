import random
from hashlib import sha256

import public_tokenizers as P
import pytest
import tiktoken

from tidemark.llm import byte_bpe as B

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def codec():
    return B.Codec(B.read_ranks(PATH), P.PATTERN)


@pytest.fixture(scope="module")
def reference():
    ranks = {token: rank for rank, token in enumerate(B.read_ranks(PATH))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(2)
    pieces = "aé ñ\n\t0!'sẞ日本😀\x00\x1c\x85▁ĠȀtheing  "
    out = ["".join(rng.choice(pieces) for _ in range(rng.choice([0, 1, 5, 60, 400]))) for _ in range(400)]
    return [*out, None, "", "ab" * 40_000, "x" * 30_000, "<|endoftext|>", " " * 5000, "é" * 3000]


def test_same_ids_as_the_rank_files_library(codec, reference):
    for text in texts():
        ids = codec.encode(text or "")
        assert ids == reference.encode_ordinary(text or "")
        assert codec.decode(ids) == (text or "").encode()


def test_every_token_and_every_character(codec, reference):
    for token in codec.tokens:
        text = token.decode(errors="ignore")
        assert codec.encode(text) == reference.encode_ordinary(text)
    for point in [*range(0xD800), *range(0xE000, 0x30000, 7)]:
        c = chr(point)
        text = f"a{c}b 1{c}2 {c}{c}"
        assert codec.encode(text) == reference.encode_ordinary(text)


def test_a_full_memory_starts_anew(codec, reference, monkeypatch):
    monkeypatch.setattr(B, "KEPT", 3)
    codec.clear()
    text = "some words and some other words, some more"
    assert codec.encode(text) == reference.encode_ordinary(text) and len(codec) <= 3


def test_frames(documents, reference):
    rows = texts()
    df = documents(rows)
    got = {r["doc_id"]: r for r in B.encode_digests(df, PATH, P.PATTERN).collect()}
    tokens = B.with_decoded(B.with_tokens(df, PATH, P.PATTERN), PATH, P.PATTERN).collect()
    assert len(tokens) == len(rows) == len(got)
    for row in tokens:
        text = rows[row["doc_id"]] or ""
        ids = reference.encode_ordinary(text)
        assert row["token_ids"] == ids and bytes(row["decoded"]) == text.encode()
        digest = got[row["doc_id"]]
        assert digest["n_tokens"] == len(ids)
        assert digest["ids_sha256"] == sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert digest["decoded_sha256"] == sha256(text.encode()).hexdigest()


def test_nothing_repeats_and_extra_columns(documents):
    assert B.encode_digests(documents([]), PATH, P.PATTERN).count() == 0
    df = documents([(1, "a"), (1, "a"), (None, None)]).selectExpr("*", "1 as id", "2 as n_tokens", "3 as token_ids")
    assert sorted(r["n_tokens"] for r in B.encode_digests(df, PATH, P.PATTERN).collect()) == [0, 1, 1]
    assert sorted(len(r["token_ids"]) for r in B.with_tokens(df, PATH, P.PATTERN).collect()) == [0, 1, 1]
