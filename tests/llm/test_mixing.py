import random
import re

import pytest
from tests.llm.build import docs, rows

from orgtrail.llm import mixing


def targets(sizes):
    """Water filling, one source at a time."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (i % 3) + 1 for i, s in enumerate(order)}
    left, open_, out = float(sum(sizes.values())), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if 3 * sizes[s] < level * weight[s]]
        if not full:
            out |= {s: level * weight[s] for s in open_}
            break
        for s in full:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
            open_.discard(s)
    return out


@pytest.fixture(scope="module")
def corpus(spark):
    draw = random.Random(3)
    texts = [" ".join("w" * draw.randint(1, 4) for _ in range(draw.randint(0, 400))) for _ in range(300)]
    sources = [draw.choice(["a", "a", "a", "b", "é", "zz", None]) for _ in texts]
    sources[:3] = ["tiny", "tiny", "none"]
    texts[:4] = ["one two", "three", "", None]
    return docs(spark, texts, sources, extra="1 as size"), texts, sources


def test_targets_fill_by_weight_up_to_three_times(corpus):
    frame, texts, sources = corpus
    found = mixing.mix(frame).collect()
    assert len(found) == len(texts)
    words = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]
    sizes = {s: sum(w for w, x in zip(words, sources, strict=True) if x == s) for s in set(sources)}
    wanted = targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in found:
        assert r["size"] == words[r.doc_id] and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(wanted[r.source])
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
    for s in sizes:
        assert taken[s] == pytest.approx(wanted[s], abs=4, rel=0.01)


def test_reruns_and_other_partitions_agree(corpus):
    frame, *_ = corpus
    first = rows(mixing.mix(frame), "doc_id", "taken")
    assert first == rows(mixing.mix(frame.repartition(7)), "doc_id", "taken")


def test_documents_are_repeated_as_taken(corpus):
    frame, *_ = corpus
    taken = {r.doc_id: (r.taken, r["size"]) for r in mixing.mix(frame).collect()}
    mixed = mixing.mixed_documents(frame)
    assert mixed.columns == frame.columns
    count = {}
    for r in mixed.collect():
        count[r.doc_id] = count.get(r.doc_id, 0) + 1
    assert count == {i: int(t / n + 0.5) for i, (t, n) in taken.items() if n and int(t / n + 0.5)}


def test_repeated_rows_and_no_rows(spark):
    frame = spark.createDataFrame([(1, "a b", "s"), (1, "a b", "s"), (None, "c", None)], "doc_id long, text string, source string")
    found = mixing.mix(frame).collect()
    assert len(found) == 3 and all(r.taken <= 3 * r["size"] for r in found)
    assert mixing.mix(frame.filter("false")).count() == 0
    assert {r.taken for r in mixing.mix(docs(spark, ["", None])).collect()} == {0}


def test_small_sources_meet_their_target_in_long_blocks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLOTS", 16)
    texts = ["w " * 997] * 9 + ["x " * 41, "y " * 7, "z " * 300] * 2
    sources = ["hot"] * 9 + ["a", None, "m"] * 2
    found = mixing.mix(docs(spark, texts, sources)).collect()
    for s in set(sources):
        own = [r for r in found if r.source == s]
        assert sum(r.taken for r in own) == pytest.approx(own[0].target, abs=1), s
        assert all(r.taken <= 3 * r["size"] for r in own)
    plan = mixing.schedule(mixing.source_targets(docs(spark, texts, sources).selectExpr("source", "n_chars as size"))).collect()
    assert len({r.slot for r in plan}) == len(plan)
    for s in set(sources):
        assert sorted(r["rank"] for r in plan if r.source == s) == list(range(sum(r.source == s for r in plan)))


def test_targets_are_planned_once(spark, capsys):
    """The schedule asks for the targets many times; planned anew each time they filled the driver's memory."""
    mixing.mix(docs(spark, ["a b", "c"], ["x", "y"])).explain(True)
    plan = capsys.readouterr().out.split("== Physical Plan ==")[1]
    assert plan.count("Window [") < 8
