import math
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import recurrent_lm as R

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*WORD.findall(lower), None]


def texts():
    rng = np.random.default_rng(3)
    frequent = [f"w{i}" for i in range(40)]
    rare = [f"rare{i}" for i in range(300)] + ["É", "日本", "\x1c"]
    out = [None, "", " \n", "W1 w1\tW1\x0bw1"]
    for _ in range(120):
        words = [str(rng.choice(frequent if rng.random() < 0.8 else rare)) for _ in range(rng.integers(0, 60))]
        out.append(" ".join(words))
    return out


def network(seed=5, n=100):
    return R.first_network(np.arange(n, 0, -1.0), 20.0, units=6, seed=seed)


def test_probabilities_sum_to_one():
    net = network()
    h = np.random.default_rng(1).uniform(-1, 1, (1, 6)).astype(np.float32)
    every = np.append(np.arange(100), len(net.inputs) - 1)
    logs = R.log_probabilities(net, np.repeat(h, len(every), axis=0), every)
    assert math.isclose(np.exp(logs).sum(), 1, rel_tol=1e-4)


def test_gradients_equal_differences():
    net = R.Network(*[p.astype(np.float64) for p in network(n=10).parameters()])
    net.member_bias[:] = np.random.default_rng(0).normal(size=net.member_bias.shape)
    rng = np.random.default_rng(2)
    target = rng.integers(0, 10, (3, 7))
    target[1, 2] = len(net.inputs) - 1
    given = np.hstack([np.full((3, 1), -1), target[:, :-1]])
    given[2, 4] = -1
    h = rng.uniform(-1, 1, (3, 6))
    _, grads, _ = R.window_gradients(net, h, given, target)
    for p, g in zip(net.parameters(), grads, strict=True):
        for _ in range(12):
            at = tuple(rng.integers(0, n) for n in p.shape)
            old, losses = p[at], []
            for step in (1e-5, -1e-5):
                p[at] = old + step
                losses.append(R.window_gradients(net, h, given, target)[0])
            p[at] = old
            assert math.isclose((losses[0] - losses[1]) / 2e-5, g[at], rel_tol=1e-4, abs_tol=1e-6)


def one_by_one(net, text):
    h, total = np.zeros((1, net.state.shape[0]), np.float32), 0.0
    for token in text:
        total += R.log_probabilities(net, h, np.array([token]))[0]
        h, _ = R.forward(net, h, np.array([token]))
    return total


def test_state_is_carried_over_whole_texts(monkeypatch):
    monkeypatch.setattr(R, "ROWS", 16)
    net = network()
    rng = np.random.default_rng(7)
    given = [rng.integers(0, 101, n) for n in (1, 1, 300, 5, 40, 40, 2)]
    given = [np.where(t == 100, len(net.inputs) - 1, t) for t in given]
    got = R.scores(net, np.concatenate(given), np.cumsum([0, *map(len, given)]))
    assert np.allclose(got, [one_by_one(net, t) for t in given], rtol=1e-4)


def test_training_lowers_the_loss(monkeypatch):
    monkeypatch.setattr(R, "LANES", 2)
    rng = np.random.default_rng(4)
    cycle = [np.append((np.arange(30) * 3 + rng.integers(0, 30)) % 90, 99) for _ in range(80)]
    net = network(n=100)
    first = np.cumsum([0, *map(len, cycle)])
    before = R.scores(net, np.concatenate(cycle), first).sum()
    after = R.scores(R.trained(net, cycle, epochs=12), np.concatenate(cycle), first).sum()
    assert after > 0.7 * before


def test_every_token_is_learned_once_with_its_state(monkeypatch):
    rng = np.random.default_rng(8)
    given = [np.append(rng.integers(0, 99, n), 99) for n in (0, 3, 700, 16, 15, 17, 40, 1, 300)]
    seen = []
    plain = R.window_gradients

    def watched(net, h, before, target):
        loss, grads, after = plain(net, h, before, target)
        seen.append((before, target, h, after))
        return loss, grads, after

    monkeypatch.setattr(R, "window_gradients", watched)
    net = network()
    given_n, class_n = R.learn(R.Steps(net, 3), given, 0.0)
    assert class_n.sum() == sum(map(len, given)) and given_n.sum() == class_n.sum() - len(given)
    assert sum(int(((b < 0) & (t >= 0)).sum()) for b, t, *_ in seen) == len(given)
    met = np.concatenate([t[t >= 0] for _, t, *_ in seen])
    assert np.array_equal(np.bincount(met), np.bincount(np.concatenate(given)))
    # With one lane the windows follow each other: the state after one is the state before the next.
    seen.clear()
    R.learn(R.Steps(net, 1), given, 0.0)
    assert all(np.array_equal(a[3], b[2]) for a, b in zip(seen, seen[1:], strict=False))
    assert np.array_equal(np.concatenate([t[0] for _, t, *_ in seen]), np.concatenate(given))


def test_a_text_beyond_a_segment_begins_anew_and_loses_nothing(monkeypatch):
    monkeypatch.setattr(R, "SEGMENT", 48)
    rng = np.random.default_rng(2)
    given = [np.append(rng.integers(0, 99, n), 99) for n in (200, 3, 47)]
    seen = []
    plain = R.window_gradients
    monkeypatch.setattr(R, "window_gradients", lambda net, h, b, t: seen.append((b, t)) or plain(net, h, b, t))
    _, class_n = R.learn(R.Steps(network(), 4), given, 0.0)
    assert class_n.sum() == sum(map(len, given))
    assert sum(int(((b < 0) & (t >= 0)).sum()) for b, t in seen) == 5 + 1 + 1


def test_windows_read_at_once_have_the_gradients_of_one_after_the_other():
    net = network()
    rng = np.random.default_rng(6)
    target = rng.integers(0, 99, (3, 40))
    given = np.concatenate([np.full((3, 1), -1), target[:, :-1]], axis=1)
    target[1, 37:] = target[2, 20:] = -1
    h = np.zeros((3, net.state.shape[0]), np.float32)
    loss, grads, _ = R.window_gradients(net, h, given, target)
    apart, sums = 0.0, None
    for low in range(0, 40, R.WINDOW):
        cut = slice(low, low + R.WINDOW)
        part, own, h = R.window_gradients(net, h, given[:, cut], target[:, cut])
        apart += part
        sums = own if sums is None else [a + b for a, b in zip(sums, own, strict=True)]
    assert np.isclose(loss, apart, rtol=1e-5)
    assert all(np.allclose(a, b, atol=1e-4) for a, b in zip(grads, sums, strict=True))


def test_averages_are_weighted_by_what_was_met():
    nets = [network(seed=s, n=100) for s in (1, 2, 3)]
    met = [(np.zeros(129, int), np.array([3, 0, 1])), (np.zeros(129, int), np.array([1, 4, 3]))]
    met[0][0][7], met[1][0][7], met[1][0][9] = 1, 3, 5
    got = R.averaged(nets[2], sum(R.packed(n, *m) for n, m in zip(nets[:2], met, strict=True)))
    a, b, old = nets
    assert np.allclose(got.inputs[7], (a.inputs[7] + 3 * b.inputs[7]) / 4, atol=1e-6)
    assert np.allclose(got.inputs[9], b.inputs[9], atol=1e-6) and np.array_equal(got.inputs[8], old.inputs[8])
    assert np.allclose(got.state, (a.state + 2 * b.state) / 3, atol=1e-6)
    assert np.allclose(got.members[0], (3 * a.members[0] + b.members[0]) / 4, atol=1e-6)
    assert np.allclose(got.member_bias[1], b.member_bias[1], atol=1e-6)


def test_all_rows_are_learned_from_long_ones_too(documents):
    # Long texts only, whose next word the one before tells.
    words = [f"w{i}" for i in range(50)]
    long = " ".join(words * 130)
    df = documents([(i, long) for i in range(6)])
    first = R.untrained(R.frequent_counts(R.token_counts(df.select("text")))).network
    model, counts = R.fitted(df)
    assert not np.array_equal(model.network.inputs, first.inputs)
    row = R.scored(documents([long]), model, counts).first()
    assert row["n_tokens"] > 5000 and row["score"] > 0.7 * row["base_score"]
    # A round takes all of its texts, many or long.
    total = R.round_sums(df.select("text"), model, 0.01, 4)
    assert total[sum(p.size for p in first.parameters()) + len(first.inputs)] == 6 * (50 * 130 + 1)


@pytest.mark.parametrize("most,own", [(1 << 18, 4096), (60, 20), (2, 1)])
def test_counts_and_base_equal_brute_force(documents, monkeypatch, most, own):
    monkeypatch.setattr(R, "MOST_BROADCAST", most)
    monkeypatch.setattr(R.untrained, "__defaults__", (own,))
    rows = texts()
    df = documents(rows)
    training = df.where("doc_id % 3 <> 0")
    model, counts = R.fitted(training)
    assert len(model.counts.hashes) <= most
    got = {r["doc_id"]: r for r in R.scored(df, model, counts).collect()}
    c = Counter(t for i, text in enumerate(rows) if i % 3 for t in tokens(text))
    n, v = sum(c.values()), len(c)
    for i, text in enumerate(rows):
        own_tokens = tokens(text)
        base = sum(math.log10((c[t] + 1) / (n + v + 1)) for t in own_tokens)
        row = got[i]
        assert (row["n_tokens"], row["n_known"]) == (len(own_tokens), sum(c[t] > 0 for t in own_tokens))
        assert row["train_tokens"] == n
        assert math.isclose(row["base_score"], base, rel_tol=1e-9)
        assert -1e6 < row["score"] < 0
    # The score is the network's, and for other words their add-one share.
    chosen = set(np.argsort([0])) and {h for h in model.own.tolist()}
    by_hash = {}
    for t in c:
        data = np.frombuffer((t or "").encode(), np.uint8)
        by_hash[t] = int(R.words(data, np.array([0, len(data)])).hashes[0]) if t else int(R.END)
    rest = {t: k for t, k in c.items() if by_hash[t] not in chosen}
    assert (model.rest_tokens, model.rest_types) == (sum(rest.values()), len(rest))
    for i in range(0, len(rows), 11):
        own_tokens = tokens(rows[i])
        hashes = []
        for t in own_tokens:
            data = np.frombuffer((t or "").encode(), np.uint8)
            hashes.append(R.words(data, np.array([0, len(data)])).hashes[0] if t else R.END)
        numbers = model.number(np.array(hashes, np.uint64))
        score = one_by_one(model.network, numbers) / math.log(10)
        for t, k in zip(own_tokens, numbers, strict=True):
            if k == len(model.network.inputs) - 1:
                score += math.log10((c[t] + 1) / (model.rest_tokens + model.rest_types + 1))
        assert math.isclose(got[i]["score"], score, rel_tol=1e-4)


def test_model_beats_the_base_on_held_out_rows(spark):
    from tidemark.llm.common import remainder

    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held_out = remainder("doc_id", 7) == 2
    model, counts = R.fitted(documents.where(~held_out))
    found = R.scored(documents.where(held_out), model, counts).toPandas()
    assert found.score.sum() > found.base_score.sum()


def test_nothing_repeats_and_long_texts(documents):
    model, counts = R.fitted(documents([]))
    rows = R.scored(documents([(1, "a"), (1, "a"), (None, None)]).selectExpr("*", "1 as row", "2 as n"), model, counts).collect()
    assert sorted(r["n_tokens"] for r in rows) == [1, 2, 2]
    assert all(r["base_score"] == 0 and r["n_known"] == 0 for r in rows)
    model, counts = R.fitted(documents(["a b", "a c"]))
    assert R.scored(documents([]), model, counts).count() == 0
    row = R.scored(documents(["a " * 60_000]), model, counts).first()
    assert row["n_tokens"] == 60_001 and math.isfinite(row["score"])


@pytest.mark.parametrize("n", [1, 7, 8, 64, 65])
def test_rows_are_summed_as_numpy_sums_values(n):
    table = np.random.default_rng(n).normal(size=(n, 5000)).astype(np.float32)
    assert np.array_equal(R._sum_of_rows(table), np.ascontiguousarray(table.T).sum(axis=1))


@pytest.mark.parametrize("kind", ["even", "alike", "few", "one", "none"])
def test_hashes_are_found_where_they_are(kind):
    rng = np.random.default_rng(9)
    every = rng.integers(0, 1 << 64, 3000, dtype=np.uint64)
    every = {
        "even": every,
        "alike": np.append(every >> np.uint64(12), every[:5]),  # most begin with the same bits
        "few": np.append(every[:5], [R.END, np.uint64((1 << 64) - 1)]),
        "one": np.array([R.END]),
        "none": every[:0],
    }[kind]
    held = np.unique(every)
    asked = np.concatenate([every, every + np.uint64(1), [R.END, np.uint64((1 << 64) - 1)]])
    places = {int(h): i for i, h in enumerate(held)}
    assert R._find(held, asked).tolist() == [places.get(int(h), -1) for h in asked]


def test_counts_are_looked_up_once_for_a_token():
    rng = np.random.default_rng(10)
    hashes = np.unique(np.append(rng.integers(0, 1 << 64, 300, dtype=np.uint64), R.END))
    asked = np.concatenate([hashes, hashes[5:50] + np.uint64(1)])
    for held in (hashes, hashes[:0]):
        model = R.untrained(R.Counts(held, np.arange(1, len(held) + 1), 10**6, 400), own_words=40)
        assert np.array_equal(model.number_at(R._find(held, asked), asked), model.number(asked))


def test_blocks_are_merged_together(documents, monkeypatch):
    parts = [np.unique(np.array(v, np.uint64), return_counts=True) for v in ([5, 5, 3], [3, 9], [], [9, 9, 9])]
    hashes, n = R._added(parts)
    assert hashes.tolist() == [3, 5, 9] and n.tolist() == [2, 2, 4]
    rows = [" ".join(f"w{k % (3 + i)}" for k in range(50)) for i in range(40)] + [None, ""]
    plain = Counter(t for text in rows for t in tokens(text))
    for most in (1_000_000, 20, 1):
        monkeypatch.setattr(R, "MERGED", most)
        found = R.token_counts(documents(rows).select("text").coalesce(1)).collect()
        assert sorted(r["n"] for r in found) == sorted(plain.values())


def lanes_one_by_one(net, given, lanes):
    """The windows of ``learn``, each lane a list: what follows what, in plain steps."""
    waiting = iter([text[low : low + R.SEGMENT] for text in given for low in range(0, len(text), R.SEGMENT)])
    held, out = [([], []) for _ in range(lanes)], []
    while True:
        for target, before in held:
            while len(target) < R.WINDOW and (text := next(waiting, None)) is not None:
                target += text.tolist()
                before += [-1, *text[:-1].tolist()]
        held = [lane for lane in held if lane[0]]
        if not held:
            return out
        n = min(-(-lanes // (R.LEAST * len(held))) * R.WINDOW, max(len(t) for t, _ in held))
        out.append([np.array([lane[k][:n] + [-1] * (n - len(lane[k])) for lane in held]) for k in (1, 0)])
        held = [(t[n:], b[n:]) for t, b in held]


@pytest.mark.parametrize("lanes", [1, 3, 40])
def test_windows_hold_what_lanes_have(monkeypatch, lanes):
    monkeypatch.setattr(R, "SEGMENT", 50)
    rng = np.random.default_rng(11)
    given = [np.append(rng.integers(0, 99, n), 99) for n in rng.integers(0, 170, 60)]
    seen = []
    plain = R.window_gradients
    monkeypatch.setattr(R, "window_gradients", lambda net, h, b, t: seen.append((b, t)) or plain(net, h, b, t))
    R.learn(R.Steps(network(), lanes), given, 0.01)
    wanted = lanes_one_by_one(network(), given, lanes)
    assert len(seen) == len(wanted)
    assert all(np.array_equal(a, b) for x, y in zip(seen, wanted, strict=True) for a, b in zip(x, y, strict=True))
