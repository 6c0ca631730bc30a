import gc
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tests.llm.build import docs

from orgtrail.llm import quality as Q
from orgtrail.llm.common import read_table

LABELS = "doc_id long, quality int, toxic int"


def corpus(spark, n=300, seed=4):
    draw = random.Random(seed)
    words = ["".join(draw.choice("abcdefgh") for _ in range(5)) for _ in range(80)]
    texts, marks = [], []
    for _ in range(n):
        good = draw.random() < 0.8
        body = [draw.choice(words) for _ in range(draw.randint(5, 60))]
        texts.append(" ".join(body) if good else " ".join(w.upper() + "!!" for w in body))
        marks.append(int(good))
    return docs(spark, texts), spark.createDataFrame([(i, m, 0) for i, m in enumerate(marks)], LABELS), marks


def test_held_out_rows_are_told_apart(spark):
    frame, labels, marks = corpus(spark)
    found = Q.quality_report(frame, labels).collect()
    assert len(found) == len(marks)
    held = [r for r in found if r.held_out]
    assert len(held) > 60
    assert np.mean([r.predicted == marks[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)


def test_held_out_accuracy_on_the_given_tables(spark):
    folder = "/root/testdata/sf0.01"
    labels = read_table(spark, folder, "labels")
    found = Q.quality_report(read_table(spark, folder, "documents"), labels)
    held = found.filter("held_out").join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in held]) > 0.95


def test_same_rows_same_scores(spark):
    frame, labels, _ = corpus(spark, 120)
    first = {r.doc_id: r.score for r in Q.quality_report(frame, labels).collect()}
    again = {r.doc_id: r.score for r in Q.quality_report(frame.repartition(5), labels.repartition(3)).collect()}
    assert first == pytest.approx(again, abs=1e-9)


def test_descent_reaches_the_best_dual(spark):
    draw = np.random.default_rng(1)
    rows = [np.sort(draw.choice(30, 6, replace=False)) for _ in range(60)]
    labels = np.array([int(r[0] % 2) for r in rows])
    weights, bias = Q.fit_svm(rows, labels, np.ones(30), 1.0, 400)
    signs = np.where(labels == 1, 1.0, -1.0)
    upper = len(labels) / (2 * np.array([(labels == 0).sum(), (labels == 1).sum()])[labels])

    def objective(w, b):
        margins = np.array([w[r].sum() / np.sqrt(6) + b for r in rows])
        return (w @ w + b * b) / 2 + (upper * np.maximum(0, 1 - signs * margins)).sum()

    best = objective(weights, bias)
    for _ in range(200):
        assert best <= objective(weights + draw.normal(scale=0.02, size=30), bias + draw.normal(scale=0.02)) + 1e-3


def test_nulls_empty_one_class_no_labels_and_no_rows(spark):
    frame = docs(spark, [None, "", "a b", "A!! B!!", "x " * 50_000], extra="'s' as score")
    found = Q.quality_report(frame, spark.createDataFrame([], LABELS)).collect()
    assert [r.score for r in found] == pytest.approx([0.5] * 5)
    ones = spark.createDataFrame([(i, 1, 0) for i in range(5)] + [(None, 1, 0), (2, None, 0)], LABELS)
    assert all(r.score > 0.99 for r in Q.quality_report(frame, ones).collect())
    assert Q.quality_report(frame.filter("false"), ones).count() == 0
    repeated = frame.unionByName(frame)
    assert Q.quality_report(repeated, ones).count() == 10
    null_id = frame.withColumn("doc_id", F.lit(None).cast("long"))
    assert Q.quality_report(null_id, ones).count() == 5


def test_ratios_and_margins_equal_plain_counting(spark, monkeypatch):
    """Class shares by feature, counted text by text, and the score by the model's definition."""
    frame, labels, marks = corpus(spark, 90)
    seen = {}
    fit = Q.fit_svm
    monkeypatch.setattr(Q, "fit_svm", lambda rows, y, ratio, *rest: seen.update(ratio=ratio, n=len(rows)) or fit(rows, y, ratio, *rest))
    repeated = frame.unionByName(frame.filter("doc_id < 10"))
    model = Q.fit_quality(repeated, labels)
    of = Q.Featurizer()
    texts = [(r.text, marks[r.doc_id]) for r in repeated.collect()]
    rows = [sum(1 for _, m in texts if m == k) for k in (0, 1)]
    held = [{}, {}]
    for text, mark in texts:
        for i in of(text).tolist():
            held[mark][i] = held[mark].get(i, 0) + 1
    for i in {*held[0], *held[1]}:
        good, bad = (held[k].get(i, 0) + 1 for k in (1, 0))
        assert seen["ratio"][i] == pytest.approx(np.log(good / (rows[1] + 2)) - np.log(bad / (rows[0] + 2)))
    assert seen["n"] == len(texts)
    for row in Q.with_quality(frame, model).collect():
        ids = of(row.text)
        margin = model.bias + sum(float(model.weights[i]) for i in ids) / np.sqrt(len(ids))
        assert row.score == pytest.approx(1 / (1 + np.exp(-(model.slope * margin + model.shift))), rel=1e-5)


def test_repeated_ids_and_long_texts_stay_within_the_bounds(spark, monkeypatch):
    frame, labels, _ = corpus(spark, 60)
    many = frame.unionByName(frame.filter("doc_id < 3").withColumn("n_chars", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(40).cast("long")))))
    sizes = []
    fit = Q.fit_svm
    monkeypatch.setattr(Q, "fit_svm", lambda rows, *rest: sizes.append((len(rows), sum(map(len, rows)))) or fit(rows, *rest))
    Q.fit_quality(many, labels, fit_on=50)
    monkeypatch.setattr(Q, "FIT_FEATURES", 2000)
    Q.fit_quality(many, labels, fit_on=50)
    assert sizes[0][0] == 50 and sizes[1][1] <= 2000


def test_labels_beyond_the_broadcast_give_the_same_scores(spark, monkeypatch):
    frame, labels, _ = corpus(spark, 80)
    wanted = {r.doc_id: r.score for r in Q.quality_report(frame, labels).collect()}
    monkeypatch.setattr(Q, "LABEL_ROWS", 0)
    found = {r.doc_id: r.score for r in Q.quality_report(frame, labels).collect()}
    assert found == pytest.approx(wanted, abs=1e-9)


def test_the_sample_is_gone_when_memory_is_given_back(spark, monkeypatch):
    given, labels = read_table(spark, "/root/testdata/sf0.001", "documents"), read_table(spark, "/root/testdata/sf0.001", "labels")
    gc.collect()
    before, held = pa.total_allocated_bytes(), []
    monkeypatch.setattr(Q, "give_back", lambda: held.append(pa.total_allocated_bytes() - before))
    Q.fit_quality(Q.training_part(given), labels)
    assert held == [0]
