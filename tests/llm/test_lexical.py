"""Ranked search against plain counting."""

import math
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from orgtrail.llm import lexical as X
from tests.llm.build import docs

TERM = re.compile(X.TERM)
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(documents, items, top):
    """The contract on lists of (id, text)."""
    words = [(i, Counter(terms(t))) for i, t in documents]
    n_docs = sum(bool(c) for _, c in words)
    length = sum(sum(c.values()) for _, c in words)
    df = Counter(t for _, c in words for t in c)
    wanted = {}
    for i, text in items:
        wanted.setdefault(i, set()).update(terms(text))
    found = []
    for item, mine in wanted.items():
        scored = []
        for doc, c in words:
            n = sum(c.values())
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * (10**9 * c[t] // (1000 * c[t] + 20 * (50 + 50 * n * n_docs // length)))
                for t in mine
                if c[t]
            )
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        for rank, (score, null, doc) in enumerate(sorted(scored)[:top], 1):
            found.append((item, rank, None if null else doc, -score))
    return sorted(found, key=repr)


def shown(df):
    return sorted((tuple(row) for row in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


TEXTS = [
    "The cat sat on the mat.",
    "the CAT, the cat; cats\x00cat",
    "",
    None,
    "ÄÖ é x éa-b_c d'e 12 3.4",
    "cat",
    "cat",
    "...  \n\t",
    "mat sat dog dog dog " * 300,
    "a aa aaa aa a",
]
ITEMS = [(1, "cat mat cat"), (2, "aa A dog"), (3, None), (4, "..."), (None, "Äö é x b"), (2, "sat"), (9, "unseen")]


@pytest.mark.parametrize("top,block_terms", [(50, 100), (2, 100), (3, 4)])
def test_ranks_equal_plain_counting(spark, top, block_terms):
    documents = docs(spark, TEXTS)
    same = documents.filter("doc_id = 1")
    null = documents.filter("doc_id = 5").selectExpr("cast(null as long) doc_id", "text", "lang", "source", "n_chars")
    whole = documents.union(same).union(null).repartition(5).withColumn("rank", documents.n_chars)
    items = spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "'x' as score", "'y' as doc_id")
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(1, TEXTS[1]), (None, TEXTS[5])]
    assert shown(X.ranked_search(whole, items, top, block_terms=block_terms)) == plain(rows, ITEMS, top)


def test_ties_at_the_cut_go_by_id_in_any_partitioning(spark):
    documents = docs(spark, ["same words"] * 200 + ["other"] * 50)
    items = spark.createDataFrame([(0, "same"), (1, "words other")], "item_id long, text string")
    rows = [(i, "same words" if i < 200 else "other") for i in range(250)]
    for n in (1, 9):
        assert shown(X.ranked_search(documents.repartition(n), items, 5)) == plain(rows, [(0, "same"), (1, "words other")], 5)


def test_empty_tables(spark):
    documents, items = docs(spark, ["a"]), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert X.ranked_search(documents, items.limit(0)).collect() == []
    assert X.ranked_search(documents.limit(0), items).collect() == []
    assert [f.name for f in X.ranked_search(documents, items.limit(0)).schema] == ["item_id", "rank", "doc_id", "score"]


def test_an_item_beyond_the_bound_is_refused(spark):
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    with pytest.raises(ValueError, match="terms"):
        X.ranked_search(docs(spark, ["a"]), items, block_terms=2)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aAbB é.\x00\x7f0_ß　", max_size=30), min_size=1, max_size=6))
def test_scan_finds_whole_terms_only(texts):
    known = sorted({t for text in texts[::2] for t in terms(text)} | {"a", "ab"})
    block = X.Block([t.encode() for t in known], None, None, None)
    found = X._occurrences(block.automaton(), [X.marked(t.encode()) for t in texts], len(known))
    shown = sorted((int(d), known[t], int(n)) for d, t, n in zip(*found))
    wanted = sorted((d, t, n) for d, text in enumerate(texts) for t, n in Counter(terms(text)).items() if t in known)
    assert shown == wanted
    assert [len(X.marked(t.encode()).split()) for t in texts] == [len(terms(t)) for t in texts]
