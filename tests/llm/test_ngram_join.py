import random
from pathlib import Path
from urllib.parse import urlparse

import numpy as np
import pytest
from tests.llm.build import docs, rows

from orgtrail.llm import ngram_join as J
from orgtrail.session import scratch_dir


def word_set(text, n=4):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1)))


def brute(texts, percent=85):
    """Component by document, from all pairs."""
    sets = [word_set(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [(i, len(sets[i]), find(i)) for i in range(len(texts))]


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(5)
    vocabulary = ["".join(draw.choice("abcdef") for _ in range(3)) for _ in range(150)]
    line = "this line is in very many of the documents here"
    texts = []
    for _ in range(60):
        base = [draw.choice(vocabulary) for _ in range(draw.randint(1, 160))]
        for _ in range(draw.randint(1, 7)):
            changed = list(base)
            for _ in range(draw.randint(0, 3)):
                changed[draw.randrange(len(changed))] = draw.choice(vocabulary)
            texts.append(" ".join(changed) + (f"\n{line}" if draw.random() < 0.5 else ""))
    texts += ["", None, "one", "ONE", "one two", "one two", "a b c d", "a b c d e", " \t\n", "Ärger", "ärger"]
    draw.shuffle(texts)
    return texts


def test_components_equal_all_pairs(spark, corpus):
    found = J.jaccard_components(docs(spark, corpus, extra="1 as cls"))
    assert rows(found, "doc_id", "n_shingles", "component_id") == sorted(brute(corpus), key=repr)


def test_chains_and_tiles(spark, monkeypatch):
    words = [f"w{i}" for i in range(130)]
    texts = [" ".join(words[i : i + 100]) for i in range(0, 30, 2)]  # each is near the next only
    monkeypatch.setattr(J, "TILE", 4)
    found = J.jaccard_components(docs(spark, texts))
    assert rows(found, "doc_id", "n_shingles", "component_id") == sorted(brute(texts), key=repr)
    assert {r.component_id for r in found.collect()} == {0}


@pytest.mark.parametrize("size", [1, 5, 6, 7, 8, 15, 16, 31, 32, 100, 255, 257, 1000])
def test_linked_sets_share_a_listing(size):
    draw = np.random.default_rng(size)
    for _ in range(40):
        a = np.unique(draw.integers(0, 1 << 63, size).astype(np.uint64))
        drop = draw.integers(0, size // 5 + 1)
        add = draw.integers(0, size // 5 + 1)
        b = np.unique(np.concatenate([a[drop:], draw.integers(0, 1 << 63, add).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if len(b) and 100 * both >= 85 * (len(a) + len(b) - both) and not np.array_equal(a, b):
            assert set(J.listings(a)) & set(J.listings(b))


def test_tree_loses_no_partner():
    draw = np.random.default_rng(2)
    base = draw.integers(0, 9, (12, J.DIMENSIONS))
    points = np.maximum(np.repeat(base, 60, axis=0) + draw.integers(-1, 2, (720, J.DIMENSIONS)), 0).astype(np.int32)
    sizes = points.sum(axis=1)
    tree = J.VectorTree(points, sizes)
    for i in range(0, 720, 37):
        bound = np.minimum(points[i], points).sum(axis=1)
        wanted = set(np.flatnonzero(bound * 185 >= 85 * (sizes[i] + sizes)))
        near, found = tree.near(points[i], int(sizes[i]), 85)
        assert set(near) == wanted and np.array_equal(found, bound[near])


def test_nulls_repeats_long_and_no_rows(spark):
    long = " ".join(f"x{i}" for i in range(20_000))
    frame = spark.createDataFrame(
        [(None, "p q r s t"), (4, "p q r s t"), (4, "p q r s t"), (3, None), (9, long), (8, long + " y")], "doc_id long, text string"
    )
    found = rows(J.jaccard_components(frame), "doc_id", "component_id")
    assert found == sorted([(None, 4), (4, 4), (4, 4), (3, 3), (9, 8), (8, 8)], key=repr)
    assert J.jaccard_components(frame.filter("false")).count() == 0


def test_one_document_of_each_group_stays(spark, corpus):
    frame = docs(spark, corpus)
    kept = J.one_of_each(frame)
    assert kept.columns == frame.columns
    assert rows(kept, "doc_id") == sorted(((i,) for i, _, c in brute(corpus) if i == c), key=repr)


def test_finer_counts_lose_no_link():
    draw = np.random.default_rng(3)
    passed = 0
    for size in (1, 2, 3, 7, 8, 9, 60, 200, 1000) * 20:
        a = np.unique(draw.integers(0, 1 << 63, size).astype(np.uint64))
        drop, add = draw.integers(0, size // 3 + 1, 2)
        b = np.unique(np.concatenate([a[drop:], draw.integers(0, 1 << 63, add).astype(np.uint64)]))
        if not len(b):
            continue
        both = len(np.intersect1d(a, b))
        likely = J.may_link(J.bins_of(a), len(a), J.bins_of(b), len(b))
        linked = 100 * both >= 85 * (len(a) + len(b) - both)
        assert likely or not linked
        passed += likely and not linked
    assert passed < 40


def test_full_bins_pass():
    a = np.arange(1, 1025, dtype=np.uint64) << np.uint64(20)  # all in one bin
    assert J.bins_of(a).max() == 255
    assert J.may_link(J.bins_of(a), len(a), J.bins_of(a[:900]), 900)


def test_what_the_search_writes_is_deleted(spark, corpus):
    shared = Path(urlparse(scratch_dir(spark, "any")).path).parent
    before = set(shared.iterdir()) if shared.exists() else set()
    J.jaccard_components(docs(spark, corpus)).count()
    assert {p.name.split("-")[0] for p in set(shared.iterdir()) - before} == {"members", "labels"}


def test_points_bound_overlaps_and_pass_few_near_copies_that_are_no_links():
    draw = np.random.default_rng(7)

    def copies(n, share, many):
        base = draw.integers(0, 1 << 63, n).astype(np.uint64)
        new = [np.where(draw.random(n) < share, base, draw.integers(0, 1 << 63, n).astype(np.uint64)) for _ in range(many)]
        return [np.unique(x) for x in new]

    for n, share, many in ((3, 0.9, 40), (300, 0.95, 40), (60_000, 0.95, 6)):  # the last has counts beyond a byte
        sets = copies(n, share, many)
        sizes = np.array([len(s) for s in sets])
        points = J.points_of([J.counts_of(s).tobytes() for s in sets])
        tree = J.VectorTree(points, sizes)
        for i, one in enumerate(sets):
            bounds = dict(zip(*(x.tolist() for x in tree.near(points[i], int(sizes[i]), 85)), strict=True))
            for j, other in enumerate(sets):
                both = len(np.intersect1d(one, other))
                if 100 * both >= 85 * (sizes[i] + sizes[j] - both):
                    assert bounds[j] >= both
    # Likeness of 0.68: 32 coordinates let most of these pairs through, so pairs grew with the group's square.
    sets = copies(300, 0.9, 100)
    points = J.points_of([J.counts_of(s).tobytes() for s in sets])
    tree = J.VectorTree(points, np.array([len(s) for s in sets]))
    passed = sum(len(tree.near(points[i], len(s), 85)[0]) for i, s in enumerate(sets))
    assert passed < 1_000


def test_a_pair_comes_from_one_of_its_listings(spark):
    # Documents of two templates agree in most shingles, but link with their own only: many listings hold both.
    draw = random.Random(11)
    base = [f"w{draw.randrange(10_000)}" for _ in range(900)]

    def changed(words, every):
        return [f"x{draw.randrange(10**9)}" if draw.random() < every else w for w in words]

    texts = [" ".join(changed(base, 0.022)) for _ in range(24)]  # likeness near the limit of a link
    sets = [J.shingle_set(t) for t in texts]
    listed = spark.createDataFrame(
        [(int(k), J.set_hash(s)) for s in sets for k in np.unique(J.listings(s))], "key long, cls long"
    )
    points = spark.createDataFrame(
        [(J.set_hash(s), len(s), J.counts_of(s).tobytes(), J.bins_of(s).tobytes()) for s in sets],
        "cls long, size long, point binary, bins binary",
    )
    rows_of = {r["cls"]: (i, r) for i, r in enumerate(points.collect())}
    keys: dict[int, list] = {}
    for r in listed.collect():
        keys.setdefault(r["key"], []).append(r["cls"])
    batches = [
        J.pa.RecordBatch.from_pydict(
            {
                "key": [k] * len(c),
                "low": [0] * len(c),
                "high": [0] * len(c),
                "cls": c,
                "label": c,
                "size": [rows_of[x][1]["size"] for x in c],
                "side": [2] * len(c),
                "point": [rows_of[x][1]["point"] for x in c],
                "earlier": [[e for e in keys if e < k and x in keys[e]] for x in c],
            }
        ).cast(
            J.pa.schema(
                [(n, J.pa.int64()) for n in ("key", "low", "high", "cls", "label", "size", "side")]
                + [("point", J.pa.binary()), ("earlier", J.pa.list_(J.pa.int64()))]
            )
        )
        for k, c in sorted(keys.items())
    ]
    # A task of its own for each listing, so that none remembers what another gave.
    found = [p for b in batches for out in J._pair_rows(85, None)([b]) for p in zip(*out.to_pydict().values(), strict=True)]
    met = [(a, b) for c in keys.values() for a in c for b in c if a < b]
    assert len(met) > 3 * len(set(met)) and len(found) == len(set(found)) > 0
    bounded = set()
    for a, b in set(met):
        p, q = (J.points_of([rows_of[x][1]["point"]])[0] for x in (a, b))
        if 185 * int(np.minimum(p, q).sum()) >= 85 * (rows_of[a][1]["size"] + rows_of[b][1]["size"]):
            bounded.add((a, b))
    assert set(found) == bounded
    whole = J.bounded_pairs(listed, points, None, 85, None).collect()
    assert {(r["a"], r["b"]) for r in whole} <= bounded


def test_components_do_not_read_their_edges_again_to_compare_them(spark, monkeypatch):
    edges = [(i + 1, i) for i in range(9)] + [(101, 100), (102, 101), (200, 100)]
    frame = spark.createDataFrame(edges, "a long, b long")

    def refused(self):
        raise AssertionError("the edges are read once more")

    monkeypatch.setattr(type(frame), "first", refused)
    found = J.components(frame)
    monkeypatch.undo()
    assert rows(found, "node", "label") == sorted([(i, 0) for i in range(10)] + [(i, 100) for i in (100, 101, 102, 200)], key=repr)
    assert J.components(frame.filter("false")).count() == 0
