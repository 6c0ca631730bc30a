"""Language identification by sparse multinomial logistic regression on character n-grams.

Features are hashed character pairs and triples of the lower-cased text, weighted by TF-IDF
(document frequencies over all learned documents) and scaled to unit length. The regression is
trained by follow-the-regularised-leader with an elastic net on a bounded sample
(``FIT_ROWS``); a part of the sample is held back to calibrate a temperature.

Edge cases: a null text, or one without a letter, is ``und`` with score 0; rows with a null
language or id are not learned from; with nothing to learn from every text is ``und``; with
one language every text with a letter gets it with score 1; repeated rows count as often as
they stand there; texts of any length are read whole; of equally likely languages the first by
code point is taken; an empty table gives no rows; clashing columns are replaced.
"""

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orgtrail.llm.common import id_crc
from orgtrail.llm.sampling import fit_rows

BITS = 13
FEATURES = 1 << BITS
#: Rows that the regression is trained on, at most; every fifth calibrates.
FIT_ROWS = 5_000
EPOCHS = 3
#: Follow-the-regularised-leader: step, its slowing, and the two penalties.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.002, 0.01
UNDETERMINED = "und"

_BLANKS = re.compile(r"\s+")


def ngram_counts(text: str) -> np.ndarray:
    """Counts of the hashed pairs and triples of characters; white space is one blank."""
    blank = f" {_BLANKS.sub(' ', text.lower()).strip()} "
    c = np.frombuffer(blank.encode("utf-32-le", "replace"), np.uint32)
    first = c * np.uint32(0x9E3779B1)
    second = c * np.uint32(0x85EBCA6B)
    pairs = first[:-1] + second[1:]
    triples = pairs[:-1] * np.uint32(3) + c[2:] * np.uint32(0xC2B2AE35)
    shift = np.uint32(32 - BITS)
    hashed = np.concatenate([(pairs ^ (pairs >> np.uint32(16))) * np.uint32(0x9E3779B1) >> shift,
                             (triples ^ (triples >> np.uint32(16))) * np.uint32(0x9E3779B1) >> shift])
    return np.bincount(hashed.astype(np.int64), minlength=FEATURES)


def has_letter(text: str | None) -> bool:
    """Some character is a letter by its Unicode category; number signs such as a half are none."""
    return text is not None and any(c.isalpha() for c in text)


def tf_idf(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and their values, of unit length."""
    ids = np.flatnonzero(counts)
    values = (1 + np.log(counts[ids])) * idf[ids]
    length = np.sqrt(values @ values)
    return ids, values / length if length else values


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # features by languages
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, text: str) -> np.ndarray:
        ids, values = tf_idf(ngram_counts(text), self.idf)
        return values @ self.weights[ids] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not has_letter(text):
            return UNDETERMINED, 0.0
        p = softmax(self.logits(text) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train_ftrl(rows, labels: np.ndarray, n_classes: int, epochs: int = EPOCHS, alpha=ALPHA, beta=BETA, l1=L1, l2=L2):
    """Weights and bias by FTRL-proximal with an elastic net; the bias is not penalised."""
    z, n = np.zeros((FEATURES + 1, n_classes)), np.zeros((FEATURES + 1, n_classes))

    def weights(zs, ns, free):
        slow = (beta + np.sqrt(ns)) / alpha
        w = -(zs - np.sign(zs) * l1) / (slow + l2) * (np.abs(zs) > l1)
        w[free] = -zs[free] / slow[free]
        return w

    draw = np.random.default_rng(11)
    for _ in range(epochs):
        for i in draw.permutation(len(rows)):
            ids = np.append(rows[i][0], FEATURES)
            values = np.append(rows[i][1], 1.0)
            w = weights(z[ids], n[ids], -1)
            error = softmax(values @ w)
            error[labels[i]] -= 1
            g = values[:, None] * error
            grown = n[ids] + g * g
            z[ids] += g - (np.sqrt(grown) - np.sqrt(n[ids])) / alpha * w
            n[ids] = grown
    w = weights(z, n, -1)
    return w[:-1], w[-1]


def calibrate(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss, of a geometric grid."""
    if not len(logits):
        return 1.0
    grid = np.geomspace(0.05, 20, 121)
    losses = [-np.log(np.clip(softmax(logits / t)[np.arange(len(labels)), labels], 1e-300, 1)).mean() for t in grid]
    return float(grid[int(np.argmin(losses))])


def _document_frequencies(batches):
    held, rows = np.zeros(FEATURES, np.int64), 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            for text in batch.slice(at, 256).column("text").to_pylist():
                held += ngram_counts(text) > 0
                rows += 1
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(-1, FEATURES, dtype=np.int32)), pa.array(np.append(rows, held))], names=["feature", "docs"]
    )


def _count_rows(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            counts = [ngram_counts(text) for text in part.column("text").to_pylist()]
            ids = [np.flatnonzero(c).astype(np.int32) for c in counts]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("lang"),
                    pa.array(ids, pa.list_(pa.int32())),
                    pa.array([c[i].astype(np.int32) for c, i in zip(counts, ids, strict=True)], pa.list_(pa.int32())),
                ],
                names=["lang", "ids", "counts"],
            )


def fit_language(docs: DataFrame, fit_on: int = FIT_ROWS) -> LanguageModel:
    """A model of ``lang`` from the documents of ``docs`` that have one, and a letter."""
    known = docs.filter("text is not null and lang is not null and doc_id is not null").select("doc_id", "text", "lang")
    found = (
        known.select("text")
        .mapInArrow(_document_frequencies, "feature int, docs long")
        .groupBy("feature")
        .agg(F.sum("docs").alias("docs"))
        .toPandas()  # FEATURES rows
    )
    held = np.zeros(FEATURES)
    some = found[found.feature >= 0]
    held[some.feature] = some.docs
    n = int(found[found.feature == -1].docs.sum())
    idf = np.log((1 + n) / (1 + held)) + 1
    chosen = fit_rows(known, fit_on)
    few = known.join(F.broadcast(chosen), "doc_id")
    sample = (
        few.filter(F.col("text").rlike(r"\p{L}"))
        .select("text", "lang")
        .mapInArrow(_count_rows, "lang string, ids array<int>, counts array<int>")
        .toPandas()
    )
    sample = sample.sort_values(["lang", "ids", "counts"], key=lambda s: s if s.name == "lang" else s.map(bytes_of))
    languages = sorted(set(sample["lang"]))
    if len(languages) < 2:
        return LanguageModel(languages, idf, np.zeros((FEATURES, len(languages))), np.zeros(len(languages)))
    rows = []
    for ids, counts in zip(sample["ids"], sample["counts"], strict=True):
        dense = np.zeros(FEATURES, np.int64)
        dense[ids] = counts
        rows.append(tf_idf(dense, idf))
    labels = np.array([languages.index(x) for x in sample["lang"]])
    back = np.arange(len(rows)) % 5 == 4
    weights, bias = train_ftrl([r for r, b in zip(rows, back, strict=True) if not b], labels[~back], len(languages))
    model = LanguageModel(languages, idf, weights, bias)
    logits = np.array([r[1] @ weights[r[0]] + bias for r, b in zip(rows, back, strict=True) if b])
    model.temperature = calibrate(logits, labels[back])
    return model


def bytes_of(values) -> bytes:
    return np.asarray(values, np.int32).tobytes()


def with_language(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The rows with ``lang_pred`` and its probability ``score``."""

    @F.pandas_udf("lang_pred string, score double")
    def predicted(parts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.predict(x) for x in parts], columns=["lang_pred", "score"])

    return (
        docs.withColumn("__lang", predicted(F.col(text)))
        .withColumns({"lang_pred": F.col("__lang.lang_pred"), "score": F.col("__lang.score")})
        .drop("__lang")
    )


def language_report(docs: DataFrame) -> DataFrame:
    """What the query returns."""
    model = fit_language(docs.filter(id_crc(F.col("doc_id")) % 4 != 2))
    held_out = (id_crc(F.col("doc_id")) % 4 == 2).alias("held_out")
    return with_language(docs.select("doc_id", "text", held_out), model).drop("text")
