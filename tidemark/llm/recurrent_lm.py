"""Log-probabilities of whole texts by a gated recurrent language model.

Tokens are a text's words, A-Z lower-cased, and one end. All training texts are
counted. The most frequent words and the end are the model's own; the output is
factored into classes of equally frequent ones and a last class for all other
words, inside which a word has its add-one share of the counts. The network is
trained in numpy by truncated backpropagation over all training texts, in rounds: a
hash deals the texts to the rounds, each task learns from its texts of a round,
beginning with the round's weights, and Spark averages what the tasks have learned.
Texts are consecutive windows with carried state; in training, it begins anew every
``SEGMENT`` tokens, and no token is left out.

Every text is scored whole: its state is carried from window to window, many
texts side by side. Counts of frequent words (``MOST_BROADCAST`` at most) are
broadcast; all others are joined.

NULL is the empty text, which has the end alone. Repeated rows are scored alike
and counted as often as they occur.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.centroids import draw
from tidemark.llm.common import LOWER, as_longs, in_arrow, text_blocks, words
from tidemark.workspace import pin

#: The hash of the end, which is no word's.
END = np.uint64(0)
MOST_BROADCAST = 1 << 18
#: Hashes that begin with the same bits and are looked through one after the other.
MOST_ALIKE = 64
#: Counts that a task gathers before it merges them, and distinct words that it hands on.
MERGED = 1_000_000
#: Words of the model, and words in a class.
OWN, CLASS = 4096, 64
UNITS = 16
#: Tokens of the texts that a task scores side by side, and rows of an output product.
TOGETHER, ROWS = 2_000_000, 16_384
#: Steps and texts side by side in training.
WINDOW, LANES = 16, 256
#: A step is taken for at least one in so many of the tokens that windows of all lanes have.
LEAST = 16
#: Tokens of a text that are learned from one after the other; its further ones are
#: learned from side by side with these, so that no task waits for one long text.
SEGMENT = 2048
#: Rounds of training, and pieces in which weights are averaged.
ROUNDS, PIECES = 4, 32


def _added(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes and their counts in all of ``found``."""
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hashes, counts = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(hashes, kind="stable")
    hashes, counts = hashes[order], counts[order]
    at = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else np.zeros(0, int)
    return hashes[at], np.add.reduceat(counts, at) if len(at) else counts


def token_counts(texts: DataFrame) -> DataFrame:
    """``word`` (hash) and ``n`` over all rows of ``text``; the end is counted once a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(hashes, counts):
            return pa.RecordBatch.from_arrays([pa.array(as_longs(hashes)), pa.array(counts)], names=["word", "n"])

        # What blocks have found is merged once there is enough of it, not block by block.
        found, held, merged_to, ends = [], 0, 0, 0
        for batch in batches:
            for low, high, data, offsets in text_blocks(batch.column(0)):
                found.append(np.unique(words(data, offsets).hashes, return_counts=True))
                held, ends = held + len(found[-1][0]), ends + high - low
                if held > merged_to + MERGED:
                    found = [_added(found)]
                    held = merged_to = len(found[0][0])
                    if held > MERGED:
                        yield rows(*found[0])
                        found, held, merged_to = [], 0, 0
        hashes, counts = _added(found)
        yield rows(np.append(hashes, END), np.append(counts, ends))

    return in_arrow(texts, run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).where("n > 0")


@dataclass
class Counts:
    """Frequent words with their counts, by hash, and the totals over all words."""

    hashes: np.ndarray
    counts: np.ndarray
    tokens: int
    types: int


def frequent_counts(counts: DataFrame) -> Counts:
    """At most ``MOST_BROADCAST`` words: all whose count's size class is high enough."""
    step = F.floor(F.log2("n") * 8).cast("int")
    sizes = counts.groupBy(step.alias("step")).agg(F.count("*").alias("types"), F.sum("n").alias("tokens"))
    steps = sorted(map(tuple, sizes.collect()), reverse=True)
    least, held = math.inf, 0
    for at, types, _ in steps:
        held += types
        if held > MOST_BROADCAST:
            break
        least = at
    if steps and least <= steps[0][0]:
        found = counts.where(step >= least).toArrow()
        hashes = found.column(0).to_numpy().astype(np.int64).view(np.uint64)
        order = np.argsort(hashes)
        hashes, n = hashes[order], found.column(1).to_numpy()[order]
    else:
        hashes, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return Counts(hashes, n, sum(t for *_, t in steps), sum(t for _, t, _ in steps))


def _find(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Places of ``values``; -1 for those that are not there."""
    n = len(sorted_values)
    if not n:
        return np.full(len(values), -1)
    # Hashes are spread evenly: about one of them begins with the same bits.
    shift = np.uint64(64 - max(1, (n - 1).bit_length()))
    starts = np.searchsorted(sorted_values, np.arange(1 << (64 - int(shift)), dtype=np.uint64) << shift)
    starts = np.append(starts, n)
    if np.diff(starts).max() > MOST_ALIKE:
        at = np.minimum(np.searchsorted(sorted_values, values), n - 1)
        return np.where(sorted_values[at] == values, at, -1)
    begin = (values >> shift).astype(np.intp)
    at, end = starts[begin], starts[begin + 1]
    out = np.where(sorted_values[np.minimum(at, n - 1)] == values, at, -1)
    left = np.flatnonzero((out < 0) & (at + 1 < end))
    at, end, wanted = at[left], end[left], values[left]
    while len(left):
        at = at + 1
        same = sorted_values[at] == wanted
        out[left[same]] = at[same]
        more = ~same & (at + 1 < end)
        left, at, end, wanted = left[more], at[more], end[more], wanted[more]
    return out


@dataclass
class Network:
    """Parameters. Token ``k`` is member ``k % CLASS`` of class ``k // CLASS``; the last class is one token."""

    inputs: np.ndarray  # (tokens, 3 units): what a token adds to the gates
    state: np.ndarray  # (units, 3 units)
    classes: np.ndarray  # (units, classes)
    class_bias: np.ndarray
    members: np.ndarray  # (classes - 1, units, CLASS)
    member_bias: np.ndarray  # (classes - 1, CLASS)

    def parameters(self) -> list[np.ndarray]:
        return [self.inputs, self.state, self.classes, self.class_bias, self.members, self.member_bias]


def first_network(frequencies: np.ndarray, rest: float, units: int = UNITS, seed: int = 17) -> Network:
    """A network that gives each token its frequency; ``rest`` is that of the last class."""
    rng = np.random.Generator(np.random.PCG64(seed))
    n = -(-len(frequencies) // CLASS)
    # A place without a token has no share.
    padded = np.full(n * CLASS, 0.0)
    padded[: len(frequencies)] = np.maximum(frequencies, 1e-3)
    padded = padded.reshape(n, CLASS)
    small = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
    with np.errstate(divide="ignore"):
        member_bias = np.maximum(np.log(padded), -60).astype(np.float32)
    class_bias = np.log(np.append(padded.sum(axis=1), max(rest, 1e-3)))
    return Network(
        small(n * CLASS + 1, 3 * units),
        small(units, 3 * units),
        small(units, n + 1),
        (class_bias - class_bias.max()).astype(np.float32),
        small(n, units, CLASS),
        member_bias - member_bias.max(axis=1, keepdims=True),
    )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    out = 0.5 * x
    np.tanh(out, out=out)
    out += 1
    out *= 0.5
    return out


def _order(numbers: np.ndarray, below: int) -> np.ndarray:
    """The stable order of numbers under ``below``; numpy sorts short ones by radix."""
    return np.argsort(numbers.astype(np.uint16) if below <= 1 << 16 else numbers, kind="stable")


def forward(net: Network, h: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, tuple]:
    """The next state after ``token``, and what the backward step needs."""
    u = h.shape[1]
    a, b = net.inputs[token], h @ net.state
    gates = _sigmoid(a[:, : 2 * u] + b[:, : 2 * u])
    z, r = gates[:, :u], gates[:, u:]
    new = r * b[:, 2 * u :]
    new += a[:, 2 * u :]
    np.tanh(new, out=new)
    after = h - new
    after *= z
    after += new
    return after, (h, token, z, r, new, b[:, 2 * u :])


def backward(
    net: Network, grad: np.ndarray, kept: tuple, d_inputs: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gradients of the state before, the token's inputs (put into ``d_inputs`` if given), and the state matrix."""
    h, _, z, r, new, recurrent = kept
    d_new = grad * (1 - z) * (1 - new * new)
    d_z = grad * (h - new) * z * (1 - z)
    d_r = d_new * recurrent * r * (1 - r)
    u = h.shape[1]
    if d_inputs is None:
        d_inputs = np.empty((len(h), 3 * u), d_new.dtype)
    d_inputs[:, :u], d_inputs[:, u : 2 * u], d_inputs[:, 2 * u :] = d_z, d_r, d_new
    d_b = d_inputs.copy()
    d_b[:, 2 * u :] *= r
    return grad * z + d_b @ net.state.T, d_inputs, h.T @ d_b


def _by_class(net: Network, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows ordered by class, and where those of each class with members begin and end."""
    n = len(net.members)
    return _order(which, n + 1), np.cumsum(np.append(0, np.bincount(which, minlength=n + 1)[:n]))


def log_probabilities(net: Network, h: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Natural log of each target's probability after state ``h``, class by class."""
    which = target // CLASS
    # A column for each state: sums over classes or members are then sums of rows.
    states = np.ascontiguousarray(h.T)
    logits = net.classes.T @ states
    logits += net.class_bias[:, None]
    out = _log_shares(logits, which)
    order, bounds = _by_class(net, which)
    order = order[: bounds[-1]]
    if len(order):
        own, logits = states[:, order], np.empty((CLASS, len(order)), h.dtype)
        for c in np.flatnonzero(np.diff(bounds)):
            cut = slice(bounds[c], bounds[c + 1])
            np.matmul(net.members[c].T, own[:, cut], out=logits[:, cut])
            logits[:, cut] += net.member_bias[c][:, None]
        out[order] += _log_shares(logits, target[order] % CLASS)
    return out


def _log_shares(logits: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Of each column of ``logits``, which are overwritten, the log of what ``chosen`` has of the whole."""
    logits -= logits.max(axis=0)
    out = logits[chosen, np.arange(len(chosen))]
    return out - np.log(_sum_of_rows(np.exp(logits, out=logits)))


def _sum_of_rows(table: np.ndarray) -> np.ndarray:
    """The rows' sum, added as numpy adds the values of a short row: the same to the last bit by rows and by columns."""
    whole = len(table) // 8 * 8
    if not whole:
        return table.sum(axis=0)
    out = np.empty(table.shape[1], table.dtype)
    for low in range(0, len(out), 2048):
        part = table[:, low : low + 2048]
        eight = part[:8].copy()
        for k in range(8, whole, 8):
            eight += part[k : k + 8]
        four = eight[::2] + eight[1::2]
        two = four[::2] + four[1::2]
        out[low : low + 2048] = two[0] + two[1]
        for row in part[whole:]:
            out[low : low + 2048] += row
    return out


def output_gradients(net: Network, h: np.ndarray, target: np.ndarray) -> tuple[float, np.ndarray, list[np.ndarray]]:
    """Loss, its gradient by the state, and by the output parameters."""
    which, rows = target // CLASS, np.arange(len(h))
    logits = h @ net.classes
    logits += net.class_bias
    logits -= logits.max(axis=1, keepdims=True)
    p = np.exp(logits, out=logits)
    p /= p.sum(axis=1, keepdims=True)
    loss = -np.log(p[rows, which]).sum(dtype=float)
    p[rows, which] -= 1
    d_h, d_classes, d_class_bias = p @ net.classes.T, h.T @ p, p.sum(axis=0)
    d_members, d_member_bias = np.zeros_like(net.members), np.zeros_like(net.member_bias)
    order, bounds = _by_class(net, which)
    order = order[: bounds[-1]]
    if not len(order):
        return loss, d_h, [d_classes, d_class_bias, d_members, d_member_bias]
    # All classes' rows side by side, class by class.
    own, q, back = h[order], np.empty((len(order), CLASS), h.dtype), np.empty((len(order), h.shape[1]), h.dtype)
    met = np.flatnonzero(np.diff(bounds))
    cuts = [slice(bounds[c], bounds[c + 1]) for c in met]
    for c, cut in zip(met, cuts, strict=True):
        np.matmul(own[cut], net.members[c], out=q[cut])
        q[cut] += net.member_bias[c]
    q -= q.max(axis=1, keepdims=True)
    np.exp(q, out=q)
    q /= q.sum(axis=1, keepdims=True)
    at = rows[: len(order)], target[order] % CLASS
    loss -= np.log(q[at]).sum(dtype=float)
    q[at] -= 1
    for c, cut in zip(met, cuts, strict=True):
        np.matmul(q[cut], net.members[c].T, out=back[cut])
        np.matmul(own[cut].T, q[cut], out=d_members[c])
    d_member_bias[met] = np.add.reduceat(q, bounds[met], axis=0)
    d_h[order] += back
    return loss, d_h, [d_classes, d_class_bias, d_members, d_member_bias]


def window_gradients(
    net: Network, h: np.ndarray, given: np.ndarray, target: np.ndarray
) -> tuple[float, list[np.ndarray], np.ndarray]:
    """Loss and gradients of a window (lanes by steps), and the state after it.

    ``given`` is the token before each target, -1 where a text begins; there the
    state is zero. A target of -1 is none; behind it a lane has no others. No gradient
    goes back beyond ``WINDOW`` steps from the last multiple of it.
    """
    lanes, steps = target.shape
    kept, states = [], []
    for t in range(steps):
        begins = given[:, t] < 0
        h, step = forward(net, h, np.maximum(given[:, t], 0))
        h[begins] = 0
        kept.append((begins, step))
        states.append(h)
    states, target = np.concatenate(states), target.T.ravel()
    real = target >= 0
    loss, d_real, output = output_gradients(net, states[real], target[real])
    d_states = np.zeros_like(states)
    d_states[real] = d_real
    d_states = d_states.reshape(steps, lanes, -1)
    d_inputs, d_state = np.zeros_like(net.inputs), np.zeros_like(net.state)
    grad, rows = np.zeros_like(h), np.empty((steps, lanes, net.inputs.shape[1]), h.dtype)
    for t in reversed(range(steps)):
        begins, step = kept[t]
        if (t + 1) % WINDOW == 0:
            grad = np.zeros_like(grad)
        grad = grad + d_states[t]
        grad[begins] = 0
        grad, _, by_state = backward(net, grad, step, rows[steps - 1 - t])
        d_state += by_state
    which = np.concatenate([step[1] for _, step in reversed(kept)])
    order = _order(which, len(net.inputs))
    which = which[order]
    at = np.flatnonzero(np.append(True, which[1:] != which[:-1]))
    tokens = which[at]
    d_inputs[tokens] = np.add.reduceat(rows.reshape(steps * lanes, -1)[order], at)
    return loss, [d_inputs, d_state, *output], h


class Steps:
    """Adam's steps on the parameters of ``net``, one for at least one in ``LEAST`` of the tokens that the windows of ``lanes`` texts have."""

    def __init__(self, net: Network, lanes: int):
        self.net, self.lanes, self.turn, self.held, self.sums = net, lanes, 0, 0, None
        self.means = [np.zeros_like(p) for p in net.parameters()]
        self.squares = [np.zeros_like(p) for p in net.parameters()]

    def add(self, grads: list[np.ndarray], tokens: int, rate: float) -> None:
        self.sums = grads if self.sums is None else [a + b for a, b in zip(self.sums, grads, strict=True)]
        self.held += tokens
        if LEAST * self.held >= self.lanes * WINDOW:
            self.step(rate)

    def step(self, rate: float) -> None:
        if not self.held:
            return
        self.turn += 1
        now = rate * math.sqrt(1 - 0.99**self.turn) / (1 - 0.9**self.turn)
        for p, g, m, s in zip(self.net.parameters(), self.sums, self.means, self.squares, strict=True):
            if p is self.net.inputs:
                # Most tokens are not met between two steps; theirs stay as they are.
                met = np.flatnonzero(g.any(axis=1))
                g, mean, square = g[met] / self.held, m[met], s[met]
                mean += 0.1 * (g - mean)
                square += 0.01 * (g * g - square)
                m[met], s[met] = mean, square
                p[met] -= (now * mean / (np.sqrt(square) + 1e-6)).astype(np.float32, copy=False)
                continue
            g = g / self.held
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            p -= (now * m / (np.sqrt(s) + 1e-6)).astype(np.float32, copy=False)
        self.held, self.sums = 0, None


def learn(steps: Steps, texts: Iterable[np.ndarray], rate: float) -> tuple[np.ndarray, np.ndarray]:
    """Truncated backpropagation once over every token of ``texts`` (token numbers, each with its end).

    The steps' ``lanes`` texts are read side by side, window by window, each followed by the
    next one that waits; a text's state is carried over the windows of ``SEGMENT``
    tokens, and begins anew with the next ones. Where fewer texts are left, they are read by as many windows at once as a step takes. Returns
    how often each token was given, and how often each class was the target's.
    """
    net = steps.net
    waiting = (text[low : low + SEGMENT] for text in texts for low in range(0, len(text), SEGMENT))
    given_n, class_n = np.zeros(len(net.inputs), np.int64), np.zeros(len(net.class_bias), np.int64)
    # A row for each lane: the tokens from ``low`` to ``high`` are still to be learned from.
    held = np.empty((steps.lanes, SEGMENT + WINDOW), np.int32)
    before = np.empty_like(held)
    low, high, lane = (np.zeros(steps.lanes, int) for _ in range(3))
    lane[:] = np.arange(steps.lanes)
    h = np.zeros((steps.lanes, net.state.shape[0]), np.float32)
    more = True
    while True:
        for k in np.flatnonzero(high - low < WINDOW) if more else []:
            rest = high[k] - low[k]
            for table in (held, before):
                table[lane[k], :rest] = table[lane[k], low[k] : high[k]]
            low[k], high[k] = 0, rest
            while high[k] < WINDOW and (text := next(waiting, None)) is not None:
                end = high[k] + len(text)
                held[lane[k], high[k] : end] = text
                before[lane[k], high[k]], before[lane[k], high[k] + 1 : end] = -1, text[:-1]
                high[k] = end
            more = high[k] >= WINDOW
            if not more:
                break
        left = np.flatnonzero(high > low)
        if not len(left):
            break
        if len(left) < len(lane):
            low, high, lane, h = low[left], high[left], lane[left], h[left]
        windows = -(-steps.lanes // (LEAST * len(lane)))
        n = min(windows * WINDOW, int((high - low).max()))
        at = low[:, None] + np.arange(n)
        there = at < high[:, None]
        at = np.where(there, at, 0)
        target, given = (np.where(there, table[lane[:, None], at], -1) for table in (held, before))
        _, grads, h = window_gradients(net, h, given, target)
        real = target[there]
        steps.add(grads, len(real), rate)
        given_n += np.bincount(given[given >= 0], minlength=len(given_n))
        class_n += np.bincount(real // CLASS, minlength=len(class_n))
        low = np.minimum(low + n, high)
    steps.step(rate)
    return given_n, class_n


def trained(net: Network, texts: list[np.ndarray], epochs: int = 2, rate: float = 0.01) -> Network:
    """``net`` after ``epochs`` times ``texts``, on one machine."""
    steps = Steps(net, LANES)
    for epoch in range(epochs):
        learn(steps, texts, rate * (1 - epoch / epochs))
    return net


def _shares(net: Network, given_n: np.ndarray, class_n: np.ndarray) -> list[np.ndarray]:
    """How much each parameter's rows count in an average: by the tokens they were learned from."""
    tokens, members = class_n.sum(keepdims=True), class_n[:-1]
    by_row = [given_n, tokens, tokens, tokens, members, members]
    return [
        np.broadcast_to(w, len(p)).astype(np.float64).reshape(-1, *[1] * (p.ndim - 1))
        for p, w in zip(net.parameters(), by_row, strict=True)
    ]


def packed(net: Network, given_n: np.ndarray, class_n: np.ndarray) -> np.ndarray:
    """Weighted parameters and their weights as one vector; the vectors of tasks are summed."""
    shares = _shares(net, given_n, class_n)
    weighted = [(p * w).ravel() for p, w in zip(net.parameters(), shares, strict=True)]
    return np.concatenate([*weighted, *[w.ravel() for w in shares]])


def averaged(net: Network, total: np.ndarray) -> Network:
    """The average that ``total``, a sum of ``packed``, stands for; what no task has met stays as in ``net``."""
    parameters = net.parameters()
    sizes = [p.size for p in parameters] + [len(p) for p in parameters]
    parts = np.split(total, np.cumsum(sizes)[:-1])
    out = []
    for p, weighted, w in zip(parameters, parts[: len(parameters)], parts[len(parameters) :], strict=True):
        w = w.reshape(-1, *[1] * (p.ndim - 1))
        mean = weighted.reshape(p.shape) / np.maximum(w, 1)
        out.append(np.where(w > 0, mean, p).astype(np.float32))
    return Network(*out)


def scores(net: Network, tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Natural log-probability of each text, whose tokens are those from ``first[i]`` to ``first[i + 1]``."""
    length = np.diff(first)
    order = np.argsort(-length, kind="stable")
    begin, length = first[:-1][order], length[order]
    total = np.zeros(len(order))
    h = np.zeros((len(order), net.state.shape[0]), np.float32)
    t, longest = 0, int(length[0]) if len(length) else 0
    # How many texts have more than t tokens.
    runs = np.searchsorted(-length, -np.arange(longest), "left").tolist()
    while t < longest:
        states, targets, owners, held = [], [], [], 0
        while t < longest and held < ROWS:
            running = runs[t]
            target = tokens[begin[:running] + t]
            states.append(h[:running])
            targets.append(target)
            owners.append(running)
            held += running
            h, _ = forward(net, h[:running], target)
            t += 1
        state, target = np.concatenate(states), np.concatenate(targets)
        logs = np.empty(len(target))
        for low in range(0, len(target), ROWS):
            cut = slice(low, low + ROWS)
            logs[cut] = log_probabilities(net, state[cut], target[cut])
        low = 0
        for running in owners:
            total[:running] += logs[low : low + running]
            low += running
    out = np.empty(len(order))
    out[order] = total
    return out


@dataclass
class Model:
    counts: Counts
    #: Hashes of the model's own tokens, sorted, and their numbers.
    own: np.ndarray
    numbers: np.ndarray
    rest_tokens: int
    rest_types: int
    network: Network

    def number_at(self, at: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The numbers of ``hashes`` that are in the counts' places ``at`` (-1: not there)."""
        if not len(self.counts.hashes):
            return self.number(hashes)
        return np.append(self.number(self.counts.hashes), len(self.network.inputs) - 1)[at]

    def number(self, hashes: np.ndarray) -> np.ndarray:
        at = _find(self.own, hashes)
        rest = len(self.network.inputs) - 1
        return np.where(at < 0, rest, self.numbers[np.maximum(at, 0)] if len(self.numbers) else rest)


def untrained(counts: Counts, own_words: int = OWN) -> Model:
    order = np.lexsort((counts.hashes, -counts.counts))
    ends = order[counts.hashes[order] == END]
    chosen = np.concatenate([ends, order[counts.hashes[order] != END][: own_words - 1]])
    chosen = chosen[np.lexsort((counts.hashes[chosen], -counts.counts[chosen]))]
    hashes, n = counts.hashes[chosen], counts.counts[chosen]
    if not len(hashes):
        hashes, n = np.array([END]), np.array([1])
    rest_tokens = counts.tokens - int(counts.counts[chosen].sum())
    rest_types = counts.types - len(chosen)
    by_hash = np.argsort(hashes)
    network = first_network(n.astype(float), float(rest_tokens) + 1)
    return Model(counts, hashes[by_hash], by_hash, rest_tokens, rest_types, network)


def with_ends(found) -> tuple[np.ndarray, np.ndarray]:
    """Hashes with the end after each text, and where each text begins."""
    ends = found.first[1:]
    return np.insert(found.hashes, ends, END), found.first + np.arange(len(found.first))


def round_sums(texts: DataFrame, model: Model, rate: float, lanes: int = LANES) -> np.ndarray | None:
    """Sum over all tasks of what they have learned from ``text``, each beginning with the model's network."""
    shared = texts.sparkSession.sparkContext.broadcast((model.own, model.numbers, model.network))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, numbers, net = shared.value
        net = Network(*[p.copy() for p in net.parameters()])
        known = np.append(numbers, len(net.inputs) - 1)

        def read() -> Iterator[np.ndarray]:
            for batch in batches:
                for _, _, data, offsets in text_blocks(batch.column(0)):
                    tokens, first = with_ends(words(data, offsets))
                    tokens = known[_find(hashes, tokens)]
                    yield from np.split(tokens, first[1:-1])

        given_n, class_n = learn(Steps(net, lanes), read(), rate)
        if class_n.any():
            pieces = np.array_split(packed(net, given_n, class_n), PIECES)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(PIECES)), pa.array([v.tobytes() for v in pieces], pa.binary())], names=["piece", "v"]
            )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, v in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                v = np.frombuffer(v.as_buffer(), np.float64)
                total[piece] = total[piece] + v if piece in total else v.copy()
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int64()), pa.array([v.tobytes() for v in total.values()], pa.binary())],
            names=["piece", "v"],
        )

    schema = "piece long, v binary"
    learned = in_arrow(texts, run, schema).repartition(PIECES, "piece")
    found = {piece: np.frombuffer(v) for piece, v in in_arrow(learned, add, schema).collect()}
    shared.unpersist()
    return np.concatenate([found[k] for k in range(PIECES)]) if found else None


def fitted(
    training: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS, rate: float = 0.01
) -> tuple[Model, DataFrame]:
    """A model of all rows of ``training``, and the counts that it is to be used with."""
    rows = training.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    counts = pin(token_counts(rows.select("text")), "counts")
    model = untrained(frequent_counts(counts))
    dealt = F.floor(draw(F.struct("id", F.xxhash64("text"))) * rounds)
    for k in range(rounds):
        total = round_sums(rows.where(dealt == k).select("text"), model, rate * (1 - k / rounds))
        if total is not None:
            model.network = averaged(model.network, total)
    return model, counts


def scored(
    documents: DataFrame, model: Model, counts: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: id, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` (log10)."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema[0].dataType.simpleString()
    sums = ["n_tokens", "n_known", "n_rest", "log_known", "log_rest", "network"]
    names = ["row", "id", *sums, "rare"]
    pair = pa.struct([("word", pa.int64()), ("n", pa.int64())])

    def scored_pool(known: Model, pool: list, number: int) -> pa.RecordBatch:
        hashes = np.concatenate([p[1] for p in pool])
        shift = np.cumsum([0, *[len(p[1]) for p in pool]])
        first = np.concatenate([*[p[2][:-1] + s for p, s in zip(pool, shift[:-1], strict=True)], shift[-1:]])
        n = len(first) - 1
        owner = np.repeat(np.arange(n), np.diff(first))
        at = _find(known.counts.hashes, hashes)
        logs = np.append(np.log10(known.counts.counts + 1.0), 0.0)[at]
        numbers = known.number_at(at, hashes)
        rest = numbers == len(known.network.inputs) - 1
        lost = (at < 0) & (hashes != END)
        who, what = owner[lost], hashes[lost]
        order = np.lexsort((what, who))
        who, what = who[order], what[order]
        new = np.ones(len(who), bool)
        new[1:] = (who[1:] != who[:-1]) | (what[1:] != what[:-1])
        place = np.flatnonzero(new)
        times = np.diff(np.append(place, len(who)))
        bounds = np.searchsorted(who[place], np.arange(n + 1)).astype(np.int32)
        rare = pa.StructArray.from_arrays([pa.array(as_longs(what[place])), pa.array(times)], fields=list(pair))
        total = lambda v: np.bincount(owner, v, n)
        values = [np.diff(first), total(at >= 0), total(rest), total(logs), total(logs * rest)]
        values.append(scores(known.network, numbers, first) / math.log(10))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.arange(number, number + n)),
                pa.concat_arrays([p[0] for p in pool]),
                *[pa.array(v.astype(np.int64)) for v in values[:3]],
                *[pa.array(v) for v in values[3:]],
                pa.ListArray.from_arrays(pa.array(bounds), rare),
            ],
            names=names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        number, pool, held = TaskContext.get().partitionId() << 33, [], 0
        for batch in batches:
            for low, high, data, offsets in text_blocks(batch.column(1)):
                tokens, first = with_ends(words(data, offsets, LOWER))
                pool.append((batch.column(0).slice(low, high - low), tokens, first))
                held += len(tokens)
                if held >= TOGETHER:
                    out = scored_pool(known, pool, number)
                    number, pool, held = number + out.num_rows, [], 0
                    yield out
        if pool:
            yield scored_pool(known, pool, number)

    fields = ", ".join(f"{s} {'long' if s.startswith('n_') else 'double'}" for s in sums)
    schema = f"row long, id {kind}, {fields}, rare array<struct<word:long,n:long>>"
    local = pin(in_arrow(rows, run, schema), "scored")
    rare = local.select("row", F.explode("rare").alias("rare")).select("row", "rare.word", F.col("rare.n").alias("times"))
    added = (
        rare.join(counts, "word")
        .groupBy("row")
        .agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("log_more"))
    )
    tokens, types = model.counts.tokens, model.counts.types
    more, log_more = F.coalesce("more", F.lit(0)), F.coalesce("log_more", F.lit(0.0))
    return (
        local.drop("rare")
        .join(added, "row", "left")
        .select(
            F.col("id").alias(id_col),
            "n_tokens",
            (F.col("n_known") + more).cast("long").alias("n_known"),
            F.lit(tokens).cast("long").alias("train_tokens"),
            (F.col("log_known") + log_more - F.col("n_tokens") * math.log10(tokens + types + 1)).alias("base_score"),
            (
                F.col("network")
                + F.col("log_rest")
                + log_more
                - F.col("n_rest") * math.log10(model.rest_tokens + model.rest_types + 1)
            ).alias("score"),
        )
    )
