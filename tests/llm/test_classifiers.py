"""Held-out accuracy on the example tables, and the odd rows, of the three learned classifiers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import centroids as C, neighbours as N, toxicity as X
from tidemark.llm.common import remainder

FOLDER = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")


def auc(labels, scores):
    import pandas as pd

    ranks, labels = pd.Series(scores).rank().to_numpy(), np.asarray(labels)
    positive, negative = (labels == 1).sum(), (labels == 0).sum()
    return (ranks[labels == 1].sum() - positive * (positive + 1) / 2) / (positive * negative)


def held_out(scored, labels, by, what):
    return scored.join(labels.where(remainder("doc_id", by) == what), "doc_id").toPandas()


def test_toxicity_on_held_out_rows(tables):
    documents, labels = tables
    model = X.fitted(documents, labels.where(remainder("doc_id", 4) != 2))
    found = held_out(X.scored(documents, model), labels, 4, 2)
    assert auc(found.toxic, found.score) > 0.95
    assert (found.score >= 0.3)[found.toxic == 1].mean() > 0.9
    assert (found.score >= 0.3)[found.toxic == 0].mean() < 0.03


def test_quality_on_held_out_rows(tables):
    documents, labels = tables
    model = N.fitted(documents, labels.where(remainder("doc_id", 3) != 1))
    found = held_out(N.scored(documents.select("doc_id", "text"), model), labels, 3, 1)
    assert auc(found.quality, found.score) > 0.99
    assert (found.score >= 0.5)[found.quality == 1].mean() > 0.99


def test_languages_on_held_out_rows(tables):
    documents, _ = tables
    out = remainder("doc_id", 4) == 2
    model = C.fitted(documents.where(~out))
    found = C.predicted(documents.where(out), model).join(documents.select("doc_id", "lang"), "doc_id").toPandas()
    assert (found.lang == found.lang_pred).mean() > 0.99
    assert found.score.between(0, 1).all() and found.rejected.mean() < 0.05


ODD = [(1, None), (2, ""), (3, "  \n"), (4, "1234 !!"), (5, "the the"), (5, "the the"), (None, "idiot"), (7, "word " * 200_000)]


def toy(spark, documents):
    rows = [(i, f"you idiot moron again {i}") if i % 3 == 0 else (i, f"the good text number {i} of them") for i in range(90)]
    labels = [(i, int(i % 3 != 0), int(i % 3 == 0)) for i in range(90)]
    labels += [(0, 0, 1), (500, 1, 0), (None, 1, 1), (4, None, None), (5, 7, 7)]
    clash = "*", "1 as id", "2 as score", "3 as label", "4 as rejected"
    return documents(rows).selectExpr(*clash), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_odd_rows(spark, documents):
    given, labels = toy(spark, documents)
    odd = documents(ODD).selectExpr("*", "1 as id", "2 as score", "3 as rejected")
    found = X.scored(odd, X.fitted(given, labels)).collect()
    assert len(found) == len(ODD)
    score = {r["doc_id"]: r["score"] for r in found}
    assert score[None] > 0.5 > score[7] and score[1] == score[2] == score[3] == 0
    found = N.scored(odd, N.fitted(given, labels)).collect()
    assert len(found) == len(ODD) and all(0 <= r["score"] <= 1 for r in found)
    found = C.predicted(odd, C.fitted(given)).collect()
    named = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in found}
    assert len(found) == len(ODD) and named[5][0] == named[7][0] == "en"
    assert all(named[i] == ("und", 0.0) for i in (1, 2, 3, 4))


def test_nothing_to_learn_from_or_to_score(spark, documents):
    given, labels = toy(spark, documents)
    none, few = documents([]), documents([(1, "some text"), (2, None)])
    for learned in ((given, labels.limit(0)), (none, labels)):
        assert [r["score"] for r in X.scored(few, X.fitted(*learned)).collect()] == [0.0, 0.0]
        assert [r["score"] for r in N.scored(few, N.fitted(*learned)).collect()] == [0.5, 0.5]
    assert {r["lang_pred"] for r in C.predicted(few, C.fitted(none)).collect()} == {"und"}
    assert X.scored(none, X.fitted(given, labels)).count() == 0
    assert N.scored(none, N.fitted(given, labels)).count() == 0
    assert C.predicted(none, C.fitted(given)).count() == 0


def test_order_of_rows_does_not_matter(spark, documents):
    given, labels = toy(spark, documents)
    turned = given.orderBy(F.desc("doc_id")).repartition(2), labels.orderBy(F.desc("doc_id"))
    one, other = X.fitted(given, labels), X.fitted(*turned)
    assert one.weights == other.weights and np.allclose((one.slope, one.offset), (other.slope, other.offset))
    one, other = N.fitted(given, labels), N.fitted(*turned)
    assert np.array_equal(one.vectors, other.vectors)
    assert np.array_equal(C.fitted(given).centroids, C.fitted(turned[0]).centroids)


def test_folding():
    assert X.folded("1d10t STÜPІD idiоt!! $tup!d, a@b ｍｏｒｏｎ mo​ron") == [
        "idiot", "stupid", "idiot", "stupid", "aab", "moron", "moron",
    ]
    assert X.folded(None or "") == []


def test_every_lookalike_folds_to_its_letter():
    for odd, letter in X.LOOKALIKES.items():
        assert X.folded(f"a{odd}b") == X.folded(f"a{letter}b"), odd
    assert X.folded("sτupid sтupid") == ["stupid", "stupid"]


def test_matches_equal_a_plain_search_of_the_lexicon():
    rng = np.random.default_rng(7)
    pick = lambda values, n: [values[i] for i in rng.integers(0, len(values), n)]
    parts = ["trash", "tras", "idiot", "idio", "moron", "can", "good", "text", "a", "an", "circus", "clown"]
    for _ in range(60):
        words = sorted({*pick(parts, 6)})
        weights = {e: float(rng.integers(1, 9)) for w in words for e in X.entries(w) if rng.random() < 0.7}
        exceptions = ("trash can", "circus clown", "Idiot  good")
        automaton = X.Model(weights, exceptions).automaton()
        for _ in range(20):
            text = " ".join(pick([*parts, "trashcan", "idiots", "TRA5H", "mοron", "--", "clown."], int(rng.integers(0, 15))))
            shown = " " + " ".join(X.folded(text)) + " "
            at = lambda entry: [i for i in range(len(shown)) if shown.startswith(entry, i)]  # noqa: E731, B023
            spared = [(i, i + len(p) - 1) for p in (f" {' '.join(X.folded(e))} " for e in exceptions) for i in at(p)]
            best = {}
            for entry, weight in weights.items():
                for i in at(entry):
                    if not any(low <= i < high for low, high in spared):
                        best[i] = max(weight, best.get(i, 0.0))
            found = X.matched(text, automaton)
            assert found == (sum(w * w for w in best.values()), len(X.folded(text)), len(best)), text


def test_language_predictions_equal_plain_vectors(spark, documents):
    """TF-IDF, cosines and rejection by Python's own numbers."""
    rng = np.random.default_rng(5)
    letters = {"xx": "abcdefgh", "yy": "mnopqrstuv", "zz": "éüß日本w"}
    text = lambda lang: "".join(rng.choice([*letters[lang], " "], 60))
    rows = [(i, text(lang), lang) for i, lang in enumerate(["xx", "yy", "zz"] * 20)]
    given = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = C.fitted(given, rows_per_language=1000, centroids_per_language=2, quantile=0.2)

    def cells(value):
        folded = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in value.encode())
        codes = [a | b << 8 for a, b in zip(folded, folded[1:], strict=False)]
        codes += [a | b << 8 | c << 16 | 1 << 24 for a, b, c in zip(folded, folded[1:], folded[2:], strict=False)]
        out = np.zeros(C.DIMS)
        for code in codes:
            out[(code * 2654435761 & 0xFFFFFFFF) >> 21] += 1
        return out

    counts = {i: cells(value) for i, value, _ in rows}
    idf = np.log((1 + len(rows)) / (1 + sum(c > 0 for c in counts.values()))) + 1
    assert np.allclose(idf, model.idf, rtol=1e-5)
    fresh = [(100 + i, text(lang), lang) for i, lang in enumerate(["xx", "yy", "zz"] * 5)] + [(200, "abc mno xyz", "xx")]
    got = {r["doc_id"]: r for r in C.predicted(spark.createDataFrame(fresh, given.schema), model).collect()}
    for i, value, _ in fresh:
        v = np.sqrt(cells(value)) * idf
        cosines = (v / np.linalg.norm(v)) @ model.centroids.T
        k = int(np.argmax(cosines))
        assert got[i]["lang_pred"] == model.languages[model.owner[k]]
        far = cosines[k] < model.limits[model.owner[k]]
        assert got[i]["rejected"] == far
        assert np.isclose(got[i]["score"], cosines[k] * (0.5 if far else 1), rtol=1e-4)
    # A limit is a low quantile of the cosines of the language's own texts.
    for k, lang in enumerate(model.languages):
        own = np.array([np.sqrt(counts[i]) * idf for i, _, name in rows if name == lang])
        own /= np.linalg.norm(own, axis=1, keepdims=True)
        nearest = np.max(own @ model.centroids[model.owner == k].T, axis=1)
        assert np.isclose(np.quantile(nearest, 0.2), model.limits[k], atol=2e-3)


def test_every_language_is_learned(spark):
    """Two hundred and fifty languages, each with a letter pair of its own."""
    pair = lambda k: chr(97 + k % 25) + chr(97 + k // 25)
    rows = [(k * 10 + i, f"{pair(k)} {pair(k)}{pair(k)} {i}", f"l{k:03d}") for k in range(250) for i in range(3)]
    given = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = C.fitted(given, centroids_per_language=1)
    assert len(model.languages) == 250
    found = C.predicted(given, model).join(given.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in found) > 0.9 * len(rows)


def test_heaviest_entry_and_exception_phrases():
    model = X.Model({" tras": 2.0, " trash ": 3.0, " idiot ": 4.0}, ("trash can",))
    found = model.automaton()
    assert X.matched("what TRA5H", found) == (9.0, 2, 1)
    assert X.matched("a trash can, trashy idiot", found) == (4.0 + 16.0, 5, 2)
    assert X.matched("nothing here", found) == (0.0, 2, 0)
    assert X.matched("idiots", X.Model({}, ()).automaton())[0] == 0.0


def test_neighbour_votes_equal_brute_force():
    rng = np.random.default_rng(1)
    vectors = N.normalised(rng.normal(size=(60, 8)).astype(np.float32))
    labels, weights = rng.integers(0, 2, 60).astype(np.float32), rng.uniform(1, 3, 60).astype(np.float32)
    axes = rng.normal(size=(N.DIMS + N.SHAPES * N.BINS, 8)).astype(np.float32)
    model = N.Model(np.ones(N.DIMS, np.float32), axes, vectors, labels, weights, 7)
    counts = rng.poisson(0.05, (20, len(axes))).astype(np.float32)
    for row, got in zip(counts, N.votes(model, counts), strict=True):
        cosine = N.normalised(N.terms(row[None], model.idf) @ axes)[0] @ vectors.T
        near = np.argsort(cosine)[-7:]
        vote = np.maximum(cosine[near], 1e-6) ** 4 * weights[near]
        assert np.isclose(got, (vote * labels[near]).sum() / vote.sum(), rtol=1e-4)
