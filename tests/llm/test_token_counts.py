import random

import pytest
from pyspark.sql import functions as F
from tests.llm.build import docs

from orgtrail.llm import token_counts as T


@pytest.fixture(scope="module")
def counter():
    return T.Counter(T.read_ranks())


def whole(counter, text):
    return len(counter.encoding.encode_ordinary(text))


def test_any_edits_equal_counting_anew(counter):
    draw = random.Random(8)
    bits = ["word", " ", "  ", "\n", "\t ", "'s", "'", "re", "l", "123", "é", "…", "!?", " the", "日本", "😀", "x"]
    for size in (0, 1, 5, 40, 400, 3000):
        for _ in range(12):
            text = "".join(draw.choice(bits) for _ in range(size))
            tree = T.CountTree(text, counter)
            assert (tree.n_chars, tree.n_tokens) == (len(text), whole(counter, text))
            for _ in range(15):
                at = draw.randint(0, len(text))
                cut = draw.choice([0, 0, 1, 3, 50])
                put = "".join(draw.choice(bits) for _ in range(draw.choice([0, 1, 2, 30])))
                text = text[:at] + put + text[at + cut :]
                tree.edit(at, cut, put)
                assert tree.text() == text
                assert (tree.n_chars, tree.n_tokens) == (len(text), whole(counter, text))


def test_a_small_edit_of_a_long_text_is_local(counter):
    tree = T.CountTree("some words in a row " * 20_000, counter)
    tree.edit(200_000, 3, "new")
    assert tree.reencoded < 1000


def test_a_long_insertion_remakes_the_tree(counter):
    tree = T.CountTree("a b c", counter)
    tree.edit(2, 1, "x y " * 5000)
    assert tree.n_tokens == whole(counter, "a " + "x y " * 5000 + " c") and len(tree.leaves) > 100


def test_report_equals_brute_force(spark, counter):
    texts = [None, "", "ab", "one line\nof text " * 30, "long " * 30_000]
    frame = docs(spark, texts, sources=["s1", None, "s3", "s4", "s5"], extra="5 as n_tokens")
    for r in T.token_report(frame).collect():
        text = texts[r.doc_id] or ""
        new, n = text, len(text)
        put = f"en {['s1', '', 's3', 's4', 's5'][r.doc_id]}"
        for at, cut, what in ((n // 4, 16, ""), (n // 2, 0, put), (int(n * 0.75), 24, text[:24])):
            at = min(at, len(new))
            new = new[:at] + what + new[at + cut :]
        assert (r.n_chars, r.n_tokens) == (n, whole(counter, text))
        assert (r.edited_chars, r.edited_tokens) == (len(new), whole(counter, new))


def test_null_and_wide_edits_repeats_and_no_rows(spark, counter):
    frame = docs(spark, ["abc def", "abc def", None])
    none = T.with_token_counts(frame, F.lit(None)).collect()
    assert [(r.n_tokens, r.edited_tokens, r.reencoded_chars) for r in none[:2]] == [(2, 2, 0)] * 2
    wide = F.array(F.struct(F.lit(-5).alias("at"), F.lit(999).alias("cut"), F.lit(None).cast("string").alias("put")))
    assert {r.edited_tokens for r in T.with_token_counts(frame, wide).collect()} == {0}
    assert T.token_report(frame.filter("false")).count() == 0
