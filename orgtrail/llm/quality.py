"""Quality classifier: a linear hinge-loss model on n-gram indicators scaled by naive Bayes.

Indicators of word and word-shape n-grams are multiplied by the log ratio of their shares in
the two classes, taken over all labelled rows. On them a support vector machine is fitted by
dual coordinate descent, on a bounded sample of labelled rows (``FIT_ROWS``), and its margin is
turned into a probability by a logistic fit. Whole texts are scored, in batches in Python
workers, with a weight vector of fixed size.

Edge cases: the empty or null text has no n-gram and gets the score of the bias; labels other
than 0 and 1, null labels and null ids are not learned from; with no label, or only one class,
every score is the share of good labels (0.5 if there are none); repeated rows count as often
as they stand there, and in the sample no more than its bound; texts of any length are read
whole; a score of just 0.5 is a 1, and of rows with equal features either may be the last in the
sample; an empty table gives no rows; clashing columns are replaced.
"""

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgtrail.llm.common import at_rest, give_back, id_crc, text_or_empty
from orgtrail.llm.sampling import fit_rows
from orgtrail.operators.sides import maybe_listed, rest

#: Size of the hashed feature space.
FEATURES = 1 << 18
#: Labelled rows that the support vector machine is fitted on, at most, and feature numbers in them.
FIT_ROWS, FIT_FEATURES = 8_000, 16_000_000
#: Labels that are broadcast, so that no text is shuffled; of more, a bitmap cuts the texts first.
LABEL_ROWS, LABEL_BYTES = 4_000_000, 64 * 1024 * 1024
EPOCHS = 12
COST = 1.0
#: Added to each class count of a feature.
SMOOTHING = 1.0
#: Distinct tokens a worker remembers.
REMEMBERED = 200_000

_SHAPES = bytes(
    ord("A") if 65 <= b <= 90 else ord("a") if 97 <= b <= 122 or b >= 128 else ord("0") if 48 <= b <= 57 else b
    for b in range(256)
)
_RUN = re.compile(rb"(.)\1+", re.S)


class Featurizer:
    """Distinct n-gram ids of a text: words and shapes, alone and in pairs."""

    def __init__(self, features: int = FEATURES):
        self.mask = np.uint32(features - 1)
        self.seen: dict[bytes, tuple[int, int]] = {}

    def _ids(self, token: bytes) -> tuple[int, int]:
        shape = _RUN.sub(rb"\1", token.translate(_SHAPES))
        found = (zlib.crc32(b"w" + token.lower()), zlib.crc32(b"s" + shape))
        if len(self.seen) >= REMEMBERED:
            self.seen.clear()
        self.seen[token] = found
        return found

    def __call__(self, text: str | None) -> np.ndarray:
        tokens = (text or "").encode("utf-8", "replace").split()
        if not tokens:
            return np.empty(0, np.int32)
        seen, ids = self.seen, self._ids
        pairs = np.array([seen.get(t) or ids(t) for t in tokens], np.uint32)
        mixed = pairs[:-1] * np.uint32(0x9E3779B1) + (pairs[1:] ^ np.uint32(0x5BD1E995)) * np.uint32(0x85EBCA6B)
        every = np.concatenate([pairs.ravel(), (mixed ^ (mixed >> np.uint32(15))).ravel()])
        return np.unique(every & self.mask).astype(np.int32)


@dataclass
class QualityModel:
    weights: np.ndarray  # per feature: coefficient times log-count ratio
    bias: float
    slope: float
    shift: float

    def margin(self, ids: np.ndarray) -> float:
        return self.bias + (float(self.weights[ids].sum()) / np.sqrt(len(ids)) if len(ids) else 0.0)

    def score(self, ids: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(ids) + self.shift, -500, 500))))


def _class_counts(batches):
    """Per feature: rows of each class that have it; one partial result per task."""
    features = Featurizer()
    counts = np.zeros((2, FEATURES), np.int64)
    rows = np.zeros(2, np.int64)
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            for text, label in zip(part.column("text").to_pylist(), part.column("label").to_pylist(), strict=True):
                counts[label, features(text)] += 1
                rows[label] += 1
    held = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.append(held, -1).astype(np.int32)),
            pa.array(np.append(counts[0, held], rows[0])),
            pa.array(np.append(counts[1, held], rows[1])),
        ],
        names=["feature", "bad", "good"],
    )


def _feature_rows(batches):
    features = Featurizer()
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            ids = [features(text) for text in part.column("text").to_pylist()]
            crcs = pa.array([zlib.crc32(of.tobytes()) for of in ids], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("label"), crcs, pa.array(ids, pa.list_(pa.int32()))], names=["label", "crc", "ids"]
            )


def fit_svm(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, cost: float, epochs: int):
    """Weights (on ``ratio``-scaled indicators) and bias, by dual coordinate descent.

    Minimises half the squared weights plus ``cost`` times the hinge losses; each class gets
    the same total cost. Steps go through the rows in a fixed shuffled order.
    """
    signs = np.where(labels == 1, 1.0, -1.0)
    share = np.array([max((labels == 0).sum(), 1), max((labels == 1).sum(), 1)])
    upper = cost * len(labels) / (2 * share[labels])
    # Values are taken from ``ratio`` when a row's turn comes: held for all rows they would double the memory.
    scales = np.array([1 / np.sqrt(max(len(ids), 1)) for ids in rows])
    norms = np.array([float(ratio[ids] @ ratio[ids]) for ids in rows]) * scales**2 + 1.0  # 1 for the bias
    weights, bias, duals = np.zeros(len(ratio)), 0.0, np.zeros(len(rows))
    draw = np.random.default_rng(7)
    for _ in range(epochs):
        for i in draw.permutation(len(rows)):
            ids, value = rows[i], ratio[rows[i]] * scales[i]
            slack = signs[i] * (float(weights[ids] @ value) + bias) - 1.0
            moved = min(max(duals[i] - slack / norms[i], 0.0), upper[i])
            step = (moved - duals[i]) * signs[i]
            if step:
                weights[ids] += step * value
                bias += step
                duals[i] = moved
    return weights, bias


def _logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through the margins, with smoothed targets."""
    good, bad = (labels == 1).sum(), (labels == 0).sum()
    # Both classes weigh the same, so that a margin of 0 stays near a score of one half.
    weight = np.where(labels == 1, 0.5 / good, 0.5 / bad)
    wanted = np.where(labels == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    slope, shift = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + shift, -500, 500)))
        error, curve = weight * (p - wanted), weight * p * (1 - p)
        gradient = np.array([error @ margins, error.sum()])
        hessian = np.array(
            [[curve @ margins**2 + 1e-6, curve @ margins], [curve @ margins, curve.sum() + 1e-6]]
        )
        step = np.linalg.solve(hessian, gradient)
        slope, shift = slope - step[0], shift - step[1]
        if abs(step).max() < 1e-6:
            break
    return float(slope), float(shift)


def fit_quality(
    docs: DataFrame, labels: DataFrame, fit_on: int = FIT_ROWS, cost: float = COST, epochs: int = EPOCHS
) -> QualityModel:
    """A model of ``labels.quality`` from the documents of ``docs`` that are labelled.

    Class counts are over all labelled rows; ``fit_on`` and ``FIT_FEATURES`` bound the rows
    that come to the driver, as lists of feature numbers. What they took is given back at the end.
    """
    try:
        return _fitted(docs, labels, fit_on, cost, epochs)
    finally:
        give_back()


def _fitted(docs: DataFrame, labels: DataFrame, fit_on: int, cost: float, epochs: int) -> QualityModel:
    known = labels.filter("quality in (0, 1) and doc_id is not null").select(
        "doc_id", F.col("quality").cast("int").alias("label")
    )
    side = rest(known, "labels")
    texts, known = docs.select("doc_id", "text"), side.frame
    if side.fits(LABEL_ROWS, LABEL_BYTES):
        labelled = texts.join(F.broadcast(known), "doc_id")
    else:
        labelled = maybe_listed(texts, side, "doc_id").join(known, "doc_id")
    counts = (
        labelled.select("text", "label")
        .mapInArrow(_class_counts, "feature int, bad long, good long")
        .groupBy("feature")
        .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
        .toPandas()  # FEATURES rows at most
    )
    total = counts[counts.feature == -1]
    bad_rows, good_rows = int(total.bad.sum()), int(total.good.sum())
    zero = np.zeros(FEATURES, np.float32)
    if not bad_rows or not good_rows:
        share = good_rows / (good_rows + bad_rows) if good_rows + bad_rows else 0.5
        share = min(max(share, 1e-9), 1 - 1e-9)
        return QualityModel(zero, 0.0, 0.0, float(np.log(share / (1 - share))))
    counts = counts[counts.feature >= 0]
    bad, good = np.full(FEATURES, SMOOTHING), np.full(FEATURES, SMOOTHING)
    bad[counts.feature] += counts.bad
    good[counts.feature] += counts.good
    ratio = np.log(good / (good_rows + 2 * SMOOTHING)) - np.log(bad / (bad_rows + 2 * SMOOTHING))
    chosen = fit_rows(labelled.select("doc_id"), fit_on)
    few = labelled.join(F.broadcast(chosen), "doc_id").select("text", "label")
    # Ids may repeat: the bounds are those of rows and of what they hold.
    found = few.mapInArrow(_feature_rows, "label int, crc long, ids array<int>").orderBy("crc", "label", F.size("ids"))
    found = at_rest(found.limit(fit_on), "quality-sample")
    sizes = found.select("crc", "label", F.size("ids").alias("n")).toPandas().sort_values(["crc", "label", "n"])
    over = sizes[sizes.n.cumsum() > FIT_FEATURES]
    if len(over):
        found = found.filter(F.col("crc") < int(over.crc.min()))
    sample = found.toArrow()
    marks, crcs = sample["label"].to_numpy(), sample["crc"].to_numpy()
    lists = sample["ids"].combine_chunks()
    del sample
    # The rows come in no particular order; this one is the same at every run.
    flat, edges = lists.values.to_numpy(), lists.offsets.to_numpy()
    order = np.lexsort((marks, crcs, np.diff(edges)))
    rows, marks = [flat[edges[i] : edges[i + 1]] for i in order], marks[order]  # views, no copies
    if len(set(marks)) < 2:
        share = good_rows / (good_rows + bad_rows)
        return QualityModel(zero, 0.0, 0.0, float(np.log(share / (1 - share))))
    weights, bias = fit_svm(rows, marks, ratio, cost, epochs)
    model = QualityModel((weights * ratio).astype(np.float32), float(bias), 1.0, 0.0)
    model.slope, model.shift = _logistic(np.array([model.margin(ids) for ids in rows]), marks)
    return model


def _score(model: QualityModel, text: Column) -> Column:
    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features = Featurizer()
        for texts in batches:
            yield pd.Series([model.score(features(x)) for x in texts], dtype="float64")

    return scored(text_or_empty(text))


def with_quality(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """The rows with ``score`` (1: good) and ``predicted``."""
    return docs.withColumn("score", _score(model, F.col(text))).withColumn(
        "predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int")
    )


def accepted(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """The rows that the model does not reject, in their own columns; tested where they are read."""
    return docs.filter(_score(model, F.col(text)) >= 0.5)


def training_part(docs: DataFrame) -> DataFrame:
    return docs.filter(id_crc(F.col("doc_id")) % 3 != 1)


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What the query returns."""
    model = fit_quality(training_part(docs), labels)
    held_out = (id_crc(F.col("doc_id")) % 3 == 1).alias("held_out")
    return with_quality(docs.select("doc_id", "text", held_out), model).drop("text")
