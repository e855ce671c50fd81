"""Toxicity by a weighted lexicon, matched by Aho-Corasick in folded texts.

Texts are folded first: letters that look alike become one letter, digits and
signs that stand for letters become those, accents and invisible characters go,
and everything else is a space. The lexicon holds folded words and beginnings of
words with a weight, learned from labelled texts as the log of how much more
frequent they are in toxic ones, shrunk for rare entries. Of the entries that
match at one word the heaviest counts, squared; words inside an exception phrase
do not. The sum, over a power of the number of words, goes through a logistic
curve; curve and power are fitted on the same texts.

The labelled texts are a sample of at most about ``rows_per_class`` of each label,
drawn by a hash of the id; the lexicon has at most ``lexicon_size`` entries, which
bounds what is broadcast. A NULL or empty text, and every text where no toxic one
was learned from, has score 0. Repeated rows are each scored; a text that is repeated
among the labelled ones counts once a label. Of entries of one weight at a word it does
not matter which counts; entries that tie for the lexicon's last places are taken in
the order of their letters. A text is folded and matched whole, however long.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import in_arrow, text_blocks
from tidemark.llm.neighbours import labelled_sample

# Letters of other scripts, and odd Latin ones, that look like Latin letters.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "к": "k", "і": "i", "ѕ": "s",
    "ԁ": "d", "һ": "h", "ј": "j", "ӏ": "i", "в": "b", "н": "h", "м": "m", "т": "t", "г": "r", "п": "n",
    "α": "a", "ε": "e", "ρ": "p", "ο": "o", "ν": "v", "ι": "i", "κ": "k", "τ": "t", "υ": "u", "χ": "x",
    "η": "n", "ω": "w", "β": "b", "ɑ": "a", "ɡ": "g", "ı": "i", "ℓ": "l",
}
#: Digits and signs that stand for letters. Capital i, l, 1 and ! are one letter.
STANDINS = dict(zip("01345789@$!l", "oieastbgasii", strict=True))
#: A sign only stands for a letter where a letter or digit follows.
_LOOSE = re.compile(r"[!$@](?![!$@]*\w)")
#: Harmless phrases around words that a lexicon may hold.
EXCEPTIONS = (
    "trash can", "trash bin", "trash bag", "trash collection", "clown fish", "circus clown", "idiot proof",
    "stupid simple", "pond scum", "sore loser", "disgusting smell", "worthless check",
)


class _Fold(dict):
    def __missing__(self, point: int) -> str:
        char = chr(point)
        if unicodedata.category(char) in ("Mn", "Me", "Cf"):
            out = ""
        else:
            base = unicodedata.normalize("NFKD", char)[:1].lower()[:1]
            base = LOOKALIKES.get(base, base)
            base = STANDINS.get(base, base)
            out = base if base.isalnum() else " "
        self[point] = out
        return out


_FOLD = _Fold()


def folded(text: str) -> list[str]:
    """The words of ``text`` after folding."""
    if "!" in text or "$" in text or "@" in text:
        text = _LOOSE.sub(" ", text)
    return text.translate(_FOLD).split()


#: Lengths of the beginnings of words that may be entries.
BEGINNINGS = (4, 5, 6, 7)


def entries(word: str) -> Iterable[str]:
    """What ``word`` may match: itself, between spaces, and its beginnings, after a space."""
    if len(word) >= 3:
        yield f" {word} "
    for n in BEGINNINGS:
        if len(word) > n:
            yield f" {word[:n]}"


@dataclass
class Model:
    weights: dict[str, float]
    exceptions: tuple[str, ...]
    slope: float = 0.0
    offset: float = -50.0
    #: The power of a text's length that its sum is divided by.
    length_power: float = 1.0

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            found.add_word(entry, (len(entry), weight))
        for phrase in self.exceptions:
            entry = f" {' '.join(folded(phrase))} "
            if entry.strip():
                found.add_word(entry, (len(entry), None))
        if len(found):
            found.make_automaton()
        return found

    def rates(self, sums: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        return np.log(sums / (lengths + 10) ** self.length_power + 1e-3)

    def score(self, sums: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        at = self.slope * self.rates(sums, lengths) + self.offset
        return np.where(sums > 0, 1 / (1 + np.exp(-np.clip(at, -50, 50))), 0.0)


def matched(text: str, automaton) -> tuple[float, int, int]:
    """The summed squared weight of a text's entries, its words, and its words hit."""
    words = folded(text)
    if not words or not len(automaton):
        return 0.0, len(words), 0
    best: dict[int, float] = {}
    spared: list[tuple[int, int]] = []
    for end, (length, weight) in automaton.iter(f" {' '.join(words)} "):
        start = end - length + 1
        if weight is None:
            spared.append((start, end))
        elif weight > best.get(start, 0.0):
            best[start] = weight
    if spared:
        best = {at: w for at, w in best.items() if not any(low <= at < high for low, high in spared)}
    return sum(w * w for w in best.values()), len(words), len(best)


def learned_weights(
    sample: DataFrame, lexicon_size: int, least_weight: float, least_texts: int, prior: float = 5.0
) -> dict[str, float]:
    """Entries and weights from (label, text) rows."""

    names = ["entry", "toxic", "clean", "toxic_texts", "clean_texts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flushed() -> pa.RecordBatch:
            rows = [(e, *[c[e] for c in counts]) for e in counts[0].keys() | counts[1].keys()]
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            kinds = [pa.string()] + [pa.int64()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        counts = [Counter() for _ in names[1:]]
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = folded(text or "")
                found = [e for w in words for e in entries(w)]
                side = 0 if label else 1
                counts[side].update(found)
                counts[side][""] += len(words)
                counts[side + 2].update({*found, ""})
                if len(counts[0]) + len(counts[1]) > 400_000:
                    yield flushed()
                    counts = [Counter() for _ in names[1:]]
        yield flushed()

    counts = (
        in_arrow(sample.dropDuplicates(["label", "text"]), run, ", ".join([f"{names[0]} string", *[f"{n} long" for n in names[1:]]]))
        .groupBy("entry")
        .agg(*[F.sum(c).alias(c) for c in names[1:]])
        .where((F.col("toxic_texts") >= least_texts) | (F.col("entry") == ""))
    )

    def log_odds(toxic: str, clean: str) -> Column:
        share = F.col(f"all.{toxic}") / (F.col(f"all.{toxic}") + F.col(f"all.{clean}"))
        odds = (F.col(toxic) + prior * share) / (F.col(clean) + prior * (1 - share))
        return F.log(odds * (1 - share) / share)

    whole = counts.where(F.col("entry") == "").select(F.struct(*names[1:]).alias("all"))
    weighed = (
        counts.where(F.col("entry") != "")
        .join(F.broadcast(whole))  # one row
        .where((F.col("all.toxic") > 0) & (F.col("all.clean") > 0))
        # By words and by texts, so that a word repeated in a few texts weighs little.
        .withColumn("weight", F.least(log_odds("toxic", "clean"), log_odds("toxic_texts", "clean_texts")))
        .where(F.col("weight") >= least_weight)
    )
    heaviest = weighed.orderBy(F.desc(F.col("weight") * F.col("toxic_texts")), "entry").limit(lexicon_size)
    return {row["entry"]: row["weight"] for row in heaviest.collect()}


def logistic(x: np.ndarray, y: np.ndarray, weights: np.ndarray, ridge: float = 1e-3) -> tuple[float, float, float]:
    """Slope and offset of a logistic curve, by Newton's method, and its log-likelihood."""
    design = np.stack([x, np.ones_like(x)], axis=1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        grad = design.T @ (weights * (y - p)) - ridge * beta
        hess = (design * (weights * p * (1 - p))[:, None]).T @ design + ridge * np.eye(2)
        step = np.linalg.solve(hess, grad)
        beta += step * min(1.0, 2 / np.abs(step).max())
        if np.abs(step).max() < 1e-8:
            break
    p = np.clip(1 / (1 + np.exp(-np.clip(design @ beta, -30, 30))), 1e-9, 1 - 1e-9)
    return float(beta[0]), float(beta[1]), float((weights * np.log(np.where(y == 1, p, 1 - p))).sum())


def fitted(
    documents: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    rows_per_class: int = 5000,
    lexicon_size: int = 5000,
    least_weight: float = 1.5,
    least_texts: int = 4,
    exceptions: tuple[str, ...] = EXCEPTIONS,
) -> Model:
    sample, share = labelled_sample(documents, labels, id_col, text_col, label_col, rows_per_class)
    model = Model(learned_weights(sample, lexicon_size, least_weight, least_texts), exceptions)
    if not model.weights:
        return model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = model.automaton()
        for batch in batches:
            found = [matched(t or "", automaton)[:2] for t in batch.column(1).to_pylist()]
            sums, lengths = (np.array(c, float) for c in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sums), pa.array(lengths)], names=["label", "sum", "length"]
            )

    rows = sorted(tuple(r) for r in in_arrow(sample, run, "label int, sum double, length double").collect())
    y, sums, lengths = np.array(rows, float).T
    weights = np.where(y == 1, 1 / share[1], 1 / share[0])
    best = -np.inf
    for power in (0.0, 0.25, 0.5, 0.75, 1.0):
        tried = Model(model.weights, exceptions, length_power=power)
        tried.slope, tried.offset, fit = logistic(tried.rates(sums, lengths), y, weights / weights.mean())
        if fit > best:
            best, model = fit, tried
    return model


def scored(documents: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``score`` (0 to 1), ``hits`` (words that matched and were not spared)."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        automaton = known.automaton()
        for batch in batches:
            for low, high, _, _ in text_blocks(batch.column(1)):
                texts = batch.column(1).slice(low, high - low).to_pylist()
                sums, lengths, hits = (np.array(c) for c in zip(*[matched(t or "", automaton) for t in texts], strict=True))
                score = known.score(sums.astype(float), lengths)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), pa.array(score), pa.array(hits.astype(np.int64))],
                    names=["id", "score", "hits"],
                )

    return in_arrow(rows, run, f"id {kind}, score double, hits long").withColumnRenamed("id", id_col)
