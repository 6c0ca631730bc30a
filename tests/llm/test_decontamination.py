import random

import pytest
from tests.llm.build import docs, rows

from orgtrail.llm import decontamination as D

ITEMS = "item_id long, text string"


def brute(texts, items):
    """Pairs whose item stands in the text: shingles within any stretch of two item lengths."""
    out = []
    for doc_id, text in enumerate(texts):
        t = D.words(text)
        for item_id, item in items:
            w = D.words(item)
            if not w:
                continue
            want, answer = D.shingles(w), set(D.question_and_answer(item)[1])
            n = 2 * len(w)
            for at in range(max(1, len(t) - n // 2)):
                part = t[at : at + n]
                if len(want & D.shingles(part, len(next(iter(want))))) >= D.OVERLAP * len(want):
                    if len(answer & set(part)) >= D.ANSWER * len(answer):
                        out.append((doc_id, item_id))
                        break
    return sorted(out)


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(6)
    vocabulary = ["".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 6))) for _ in range(400)]
    common = ["the", "of", "and", "to", "is"]
    some = lambda n: [draw.choice(common if draw.random() < 0.4 else vocabulary) for _ in range(n)]
    items = []
    for i in range(50):
        asked, told = some(draw.randint(8, 30)), some(draw.randint(1, 8))
        items.append((i, " ".join(asked).capitalize() + "? " + " ".join(told) + "."))
    items += [(90, ""), (91, None), (92, "short item."), (93, items[0][1])]
    texts = [None, ""]
    for i in range(80):
        body = some(draw.randint(20, 300))
        if i % 4 == 0:
            at = draw.randrange(len(body))
            put = items[draw.randrange(50)][1].split()
            if i % 8 == 0:
                put[len(put) // 2] = "changed"
            body[at:at] = put
        texts.append(" ".join(body))
    texts.append(items[3][1].upper())
    return texts, items


def test_pairs_equal_brute_force(spark, corpus):
    texts, items = corpus
    found = D.find_leaks(docs(spark, texts, extra="1 as bm25"), spark.createDataFrame(items, ITEMS))
    assert rows(found, "doc_id", "item_id") == sorted(brute(texts, items), key=repr)
    assert len(found.collect()) > 10


def test_parts_of_the_index_change_nothing(spark, corpus, monkeypatch):
    texts, items = corpus
    frame = spark.createDataFrame(items, ITEMS)
    whole = rows(D.find_leaks(docs(spark, texts), frame), "doc_id", "item_id", "bm25")
    monkeypatch.setattr(D.index_parts, "__defaults__", (13,))
    parts = rows(D.find_leaks(docs(spark, texts), frame), "doc_id", "item_id", "bm25")
    assert [r[:2] for r in parts] == [r[:2] for r in whole]
    assert [r[2] for r in parts] == pytest.approx([r[2] for r in whole])


def test_bounds_lose_no_item(spark, corpus):
    texts, items = corpus
    (index,) = D.index_parts(spark.createDataFrame(items, ITEMS))
    for text in texts[2:40]:
        tokens = D.words(text)
        wanted = set()
        step = index.longest
        for start in range(0, len(tokens), step):
            own = {index.number[t] for t in tokens[start : start + 2 * step] if t in index.number}
            scores = {}
            for t in own:
                for at, share in zip(*index.postings[t], strict=True):
                    scores[int(at)] = scores.get(int(at), 0) + share
            wanted |= {(start, at) for at, s in scores.items() if s >= D.RETRIEVE + 1e-6}
        assert wanted <= {(start, at) for start, _, at, _ in index.retrieve(tokens)}


def test_clean_documents_stay_whole(spark, corpus):
    texts, items = corpus
    frame = docs(spark, texts)
    kept = D.without_leaks(frame, spark.createDataFrame(items, ITEMS))
    assert kept.columns == frame.columns
    bad = {d for d, _ in brute(texts, items)}
    assert rows(kept, "doc_id") == sorted(((i,) for i in range(len(texts)) if i not in bad), key=repr)


def test_repeats_null_ids_long_and_empty_tables(spark):
    item = "what is the colour of the morning sky in may? light blue with grey"
    rows_ = [(1, "say " + item), (1, "say " + item), (None, item), (2, "x " * 20_000 + item + " y" * 20_000)]
    frame = spark.createDataFrame(rows_, "doc_id long, text string")
    items = spark.createDataFrame([(7, item), (7, item), (None, item)], ITEMS)
    found = D.find_leaks(frame, items)
    assert rows(found, "doc_id", "item_id") == sorted([(1, 7), (2, 7), (None, 7)], key=repr)
    assert {(r.question_overlap, r.answer_overlap) for r in found.collect()} == {(1.0, 1.0)}
    assert D.find_leaks(frame, items.filter("false")).count() == 0
    assert D.find_leaks(frame.filter("false"), items).count() == 0
    assert D.without_leaks(frame, items.filter("false")).count() == 4
