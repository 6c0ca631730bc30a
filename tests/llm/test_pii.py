"""Personal data: the base against plain patterns, votes, reliabilities, added spans."""

import hashlib
import re
import time

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from orgtrail.llm import pii as P
from tests.llm.build import docs

PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def passes(kind, shown):
    digits = [int(c) for c in shown if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in shown.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits[::-1])]
        return 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def plain(text):
    found = [(m.start(), i, m.end(), k) for i, (k, r) in enumerate(PLAIN.items()) for m in r.finditer(text) if passes(k, m[0])]
    return [(k, s, e) for s, _, e, k in sorted(found)]


def shown(spans):
    return [(s.kind, s.start, s.end) for s in spans]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a.b@-+ 0123456789()%é\n", max_size=60))
def test_base_equals_the_plain_patterns(text):
    assert shown(P.base_spans(text)) == plain(text)


def test_base_on_numbers_that_pass():
    text = "4111 1111 1111 1111, +1 (234) 555-0100 x.y@a.b.c@d.e 1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.004 378282246310005"
    assert shown(P.base_spans(text)) == plain(text)
    assert {k for k, _, _ in plain(text)} == set(PLAIN)


def test_long_runs_take_linear_time():
    started = time.time()
    for text in ("1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+1" * 100_000, "A" * 200_000, "a:" * 100_000, "ab at " * 40_000):
        P.wider_spans(text, P.base_spans(text))
    assert time.time() - started < 20


def test_luhn():
    assert P.luhn("4111111111111111") and not P.luhn("4111111111111112")


def test_reliabilities_come_from_agreement():
    rng = np.random.default_rng(5)
    true = rng.random(6000) < 0.4
    sure = np.array([0.95, 0.9, 0.85, 0.7])
    right = rng.random((6000, 4)) < sure
    votes = np.where(right == true[:, None], 1, -1) * (rng.random((6000, 4)) < 0.8)
    votes = np.hstack([np.zeros((6000, 1), dtype=int), votes])
    patterns, count = np.unique(votes, axis=0, return_counts=True)
    kind = np.ones(len(patterns), dtype=int)
    found = P.estimate(kind, patterns, count.astype(float))
    assert np.abs(found.right[1, 1:] - sure).max() < 0.03
    assert abs(found.share[1, 0] - 0.4) < 0.03
    assert ((found.posterior(np.ones(6000, dtype=int), votes) > 0.5) == true).mean() > 0.93
    nothing = P.estimate(np.empty(0, dtype=int), np.empty((0, 5), dtype=int), np.empty(0))
    assert (nothing.right > 0.5).all() and (nothing.share == 0.5).all()


TEXTS = [
    "write to anna.b@mail.example.org now",
    "call +32 470 12 34 56 or phone (0470) 123 456",
    "server 10.20.30.40 and 999.1.1.1",
    "card 4111 1111 1111 1111 but order 4111 1111 1111 1112",
    None,
    "",
    "contact joe [at] example [dot] com",
    "met Mr. Smith and Anna Miller there",
    "dated 2024-10-11-1999, version 1.2.3, sum 12.345.678",
    "plain words only at the end dot",
]


def test_report_on_rows_of_every_kind(spark):
    filler = [f"mail u{i}@host{i}.com, tel +1 (23{i % 10}) 555-01{i % 90 + 10}, visa 4111 1111 1111 1111" for i in range(60)]
    documents = docs(spark, TEXTS + filler + [TEXTS[0]], extra="'x' as spans").withColumn("pii", P.F.lit(1)).repartition(6)
    found = {r["doc_id"]: r for r in P.pii_report(documents).collect()}
    assert len(found) == len(TEXTS) + len(filler) + 1
    for i, text in enumerate(TEXTS):
        base = plain(text or "")
        digest = hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in base).encode()).hexdigest()
        assert found[i]["base_sha256"] == digest
        assert [found[i][f"n_{k}"] for k in PLAIN] == [sum(b[0] == k for b in base) for k in PLAIN]
        assert set(f"{k}:{s}:{e}" for k, s, e in base) <= set(found[i]["spans"].split(","))
    assert "email:8:34" in found[6]["spans"] and found[6]["n_added"] == 1
    assert found[1]["spans"] == "phone:5:21,phone:31:45"
    assert found[7]["n_added"] == 2
    for i in (3, 4, 5, 8, 9):
        assert found[i]["n_added"] == 0, found[i]


def test_spans_and_redaction(spark):
    documents = docs(spark, ["to a@b.com and 1.2.3.4", None])
    model = P.fit(documents)
    rows = P.with_spans(documents, model).withColumn("clean", P.redacted(P.F.col("text"), P.F.col("pii"))).collect()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[0]["clean"] == "to [EMAIL] and [IP]" and by_id[1]["clean"] is None
    assert [s["kind"] for s in by_id[0]["pii"]] == ["email", "ip"] and by_id[1]["pii"] == []


def test_empty_table_and_no_candidates(spark):
    documents = docs(spark, ["nothing here"])
    assert [tuple(r)[:5] for r in P.pii_report(documents).collect()] == [(0, 0, 0, 0, 0)]
    assert P.pii_report(documents.limit(0)).collect() == []
