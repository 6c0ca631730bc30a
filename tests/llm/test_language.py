import math

import numpy as np
import pytest
from tests.llm.build import docs

from orgtrail.llm import language as L
from orgtrail.llm.common import read_table


def test_held_out_accuracy_on_the_given_tables(spark):
    documents = read_table(spark, "/root/testdata/sf0.01", "documents")
    found = L.language_report(documents).join(documents.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert len(held) > 150
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in found)


def test_undetermined_one_language_nothing_learned_and_no_rows(spark):
    texts = [None, "", "12 34 !!", "hello there", "é" * 100_000] * 8
    found = L.language_report(docs(spark, texts, langs=["en"] * 40, extra="'x' as lang_pred")).collect()
    for r in found:
        assert (r.lang_pred, r.score) == (("und", 0.0) if r.doc_id % 5 < 3 else ("en", 1.0))
    nothing = L.language_report(docs(spark, texts, langs=[None] * 40)).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}
    assert L.language_report(docs(spark, texts).filter("false")).count() == 0


def test_number_signs_are_no_letters(spark):
    texts = ["½ ² Ⅷ ①", "1½", "a½", "ß", "ー々", "_"]
    assert [L.has_letter(t) for t in texts] == [False, False, True, True, True, False]
    found = {r.doc_id: r for r in L.language_report(docs(spark, texts * 8, langs=["en", "de"] * 24)).collect()}
    assert {found[i].lang_pred for i in (0, 1, 5)} == {"und"}
    assert all(found[i].lang_pred in ("en", "de") for i in (2, 3, 4))


def test_predictions_equal_plain_arithmetic(spark):
    texts = ["the cat and the dog", "der hund und die katze", "the the", "und", "zz"] * 12
    frame = docs(spark, texts, langs=["en", "de", "en", "de", "en"] * 12)
    model = L.fit_language(frame)
    for row in L.with_language(frame.limit(5), model).collect():
        counts = L.ngram_counts(row.text)
        values = {int(i): (1 + math.log(counts[i])) * model.idf[i] for i in np.flatnonzero(counts)}
        norm = math.sqrt(sum(v * v for v in values.values()))
        logits = [
            (sum(v / norm * model.weights[i][k] for i, v in values.items()) + model.bias[k]) / model.temperature
            for k in range(len(model.languages))
        ]
        odds = [math.exp(x - max(logits)) for x in logits]
        assert row.score == pytest.approx(max(odds) / sum(odds), rel=1e-6)
        assert row.lang_pred == model.languages[odds.index(max(odds))]


def test_penalties_make_it_sparse_and_two_languages_apart(spark):
    rows = [L.tf_idf(L.ngram_counts(t), np.ones(L.FEATURES)) for t in ("the cat and the dog", "der hund und die katze") * 40]
    weights, _ = L.train_ftrl(rows, np.array([0, 1] * 40), 2)
    assert 0 < (np.abs(weights).sum(axis=1) > 0).sum() < L.FEATURES // 50
    scores = [r[1] @ weights[r[0]] for r in rows[:2]]
    assert scores[0][0] > scores[0][1] and scores[1][1] > scores[1][0]


def test_temperature_fits_the_log_loss(spark):
    draw = np.random.default_rng(0)
    logits = draw.normal(size=(4000, 3))
    labels = np.array([draw.choice(3, p=p) for p in L.softmax(logits)])
    assert 0.9 < L.calibrate(logits, labels) < 1.1
    assert 3.6 < L.calibrate(logits * 4, labels) < 4.4
