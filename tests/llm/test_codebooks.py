"""Product codes against plain nearest-entry search and plain Python rounds."""

import math

import numpy as np
import pytest

from orgtrail.llm import codebooks as C

SCHEMA = "vec_id long, embedding array<float>, label int"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def plain(rows, parts, entries, rounds):
    """The contract, in loops: code, error by row and the codebooks."""
    kept = [
        (i, [math.floor(256 * x) for x in v], label)
        for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    wide = len(kept[0][1]) // parts
    cut = [[v[p * wide : (p + 1) * wide] for p in range(parts)] for _, v, _ in kept]
    books = [[row[p] for row in cut[:entries]] for p in range(parts)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for row in cut:
                members.setdefault(near(row[p], books[p])[1], []).append(row[p])
            books[p] = [
                [sum(c) // len(members[k]) for c in zip(*members[k])] if k in members else e for k, e in enumerate(books[p])
            ]
    found = []
    for (i, _, label), row in zip(kept, cut):
        best = [near(row[p], books[p]) for p in range(parts)]
        found.append((i, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best), label))
    return found, books


def test_orchard_equals_full_search_with_ties_and_repeats():
    rng = np.random.default_rng(1)
    for width, k, spread in ((1, 7, 3), (4, 64, 5), (4, 64, 300), (3, 1, 9), (0, 5, 2)):
        entries = rng.integers(-spread, spread, (k, width))
        parts = rng.integers(-2 * spread, 2 * spread, (500, width))
        gaps = ((parts[:, None, :] - entries[None]) ** 2).sum(axis=2)
        best, error = C.Codebook.of(entries).nearest(parts)
        assert (best == gaps.argmin(axis=1)).all()
        assert (error == gaps.min(axis=1)).all()


def test_orchard_compares_fewer_entries_than_there_are():
    rng = np.random.default_rng(2)
    centres = rng.integers(-20000, 20000, (64, 4))
    book = C.Codebook.of(centres)
    parts = centres[rng.integers(0, 64, 400)] + rng.integers(-50, 50, (400, 4))
    at = book.start(parts)
    error = ((parts - centres[at]) ** 2).sum(axis=1)
    within = (book.apart[at] <= 4 * error[:, None]).sum(axis=1)
    assert (book.nearest(parts)[1] <= 4 * 50 * 50).all() and within.mean() < 60


def test_whole_operator_equals_plain_rounds(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.02, 8)], int(i) % 3) for i in rng.permutation(300)]
    rows += [(None, rows[0][1], None), (7, rows[3][1], 1), (7, rows[4][1], None), rows[9]]
    rows += [(900, None, 1), (901, [math.nan] * 8, 1), (902, [math.inf] + [0.0] * 7, 2), (903, [None] + [0.0] * 7, 0)]
    df = frame(spark, [(i, v, c) for i, v, c in rows]).repartition(7)
    as_float = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], c) for i, v, c in rows]
    wanted, books = plain(as_float, 4, 16, 2)
    fitted = C.fit_codebooks(df, parts=4, entries=16)
    assert fitted.tolist() == books
    codes = C.encode(df, fitted)
    assert sorted(map(tuple, codes.select("vec_id", "code", "error", "label").collect()), key=repr) == sorted(wanted, key=repr)
    sums = {}
    for _, _, error, label in wanted:
        sums[label] = sums.get(label, 0) + error
    shown = C.with_label_errors(codes).collect()
    assert len(shown) == len(wanted)
    assert all(row["label_error"] == sums[row["label"]] for row in shown)
    near = C.decode(codes, fitted).select("decoded", "error").collect()
    assert all(len(row["decoded"]) == 8 for row in near)


def test_few_rows_no_rows_and_clashing_columns(spark):
    rows = [(2, [0.5] * 16, 1, "a", "b"), (1, [-0.5] * 16, 1, "c", None)]
    df = frame(spark, rows, SCHEMA + ", code string, label_error string")
    found = {row["vec_id"]: row for row in C.vector_code_report(df).collect()}
    assert found[1]["code"] == "00" * 16 and found[2]["code"] == "01" * 16
    assert found[1]["error"] == found[1]["label_error"] == 0
    assert len({row["codebooks_sha256"] for row in found.values()}) == 1
    assert C.vector_code_report(df.limit(0)).collect() == []
    assert C.vector_code_report(frame(spark, [(1, None, 2)])).collect() == []


def test_vectors_of_other_lengths_are_refused(spark):
    with pytest.raises(Exception, match="components"):
        C.vector_code_report(frame(spark, [(1, [0.0] * 16, 0), (2, [0.0] * 32, 0)])).collect()
    with pytest.raises(ValueError, match="equal parts"):
        C.vector_code_report(frame(spark, [(1, [0.0] * 10, 0)]))
