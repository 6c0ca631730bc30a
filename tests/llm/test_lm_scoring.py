import math
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from tests.llm.build import docs

from orgtrail.llm import attention as A
from orgtrail.llm import lm_scoring as S
from orgtrail.llm.common import id_crc, read_table
from orgtrail.llm.token_counts import RANKS, read_ranks

import zlib


def words(text):
    return [*(w.decode() for w in (text or "").encode().lower().split()), None]


def base(texts, learn):
    counts = Counter(w for t in learn for w in words(t))
    n, v = sum(counts.values()), len(counts)
    out = []
    for t in texts:
        w = words(t)
        out.append((len(w), sum(counts[x] > 0 for x in w), sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)))
    return n, out


@pytest.fixture(scope="module")
def random_model():
    draw = np.random.default_rng(0)
    follow = draw.integers(0, 3, (A.VOCABULARY, A.VOCABULARY)).astype(float)
    return A.fresh_model(follow.sum(axis=0), follow)


def brute_logs(model, ids, texts, wanted):
    """One position at a time, by definition."""
    out = []
    for t in range(len(ids)):
        start = (t // A.STEP - 1) * A.STEP
        seen = [s for s in range(max(start, 0), t + 1) if texts[s] == texts[t]]
        scores = np.array([model.query[ids[t]] @ model.key[ids[s]] / A.WIDTH**0.5 + model.distance[t - s] for s in seen])
        weight = np.exp(scores - scores.max())
        weight /= weight.sum()
        before = ids[t - 1] if t and texts[t - 1] == texts[t] else A.BEGIN
        state = sum(w * model.value[ids[s]] for w, s in zip(weight, seen, strict=True)) + model.last[ids[t]] + model.before[before]
        group, member = divmod(int(model.place[wanted[t]]), A.MEMBERS)
        total = 0.0
        for logits, at in ((model.classes @ state + model.class_bias, group), (model.members[group] @ state + model.member_bias[group], member)):
            total += logits[at] - np.log(np.exp(logits - logits.max()).sum()) - logits.max()
        out.append(total)
    return np.array(out)


def test_batched_masked_attention_equals_one_position_at_a_time(random_model, monkeypatch):
    draw = np.random.default_rng(1)
    random_model.tables["distance"] = draw.normal(size=2 * A.STEP).astype(np.float32)
    texts = np.repeat([0, 1, 2, 3], [3, 61, 8, 40])
    ids, wanted = draw.integers(0, A.VOCABULARY, (2, len(texts)))
    want = brute_logs(random_model, ids, texts, wanted)
    assert A.log_likelihoods(random_model, ids, texts, wanted) == pytest.approx(want, abs=1e-3)
    monkeypatch.setattr(A, "STRETCH", 2 * A.STEP)
    assert A.log_likelihoods(random_model, ids, texts, wanted) == pytest.approx(want, abs=1e-3)


def test_gradients_are_those_of_the_loss(random_model):
    draw = np.random.default_rng(2)
    model = A.Model(random_model.place, {k: v.astype(np.float64) for k, v in random_model.tables.items()})
    texts = np.repeat([0, 1], [20, 20])
    ids, wanted = draw.integers(0, 40, (2, 40))
    _, grads = A.gradients(model, ids, texts, wanted)
    for name in A.NAMES:
        flat, g = model.tables[name].reshape(-1), grads[name].reshape(-1)
        for at in np.argsort(-np.abs(g))[:3]:
            old = flat[at]
            flat[at] = old + 1e-4
            up = A.gradients(model, ids, texts, wanted)[0]
            flat[at] = old - 1e-4
            down = A.gradients(model, ids, texts, wanted)[0]
            flat[at] = old
            assert (up - down) / 2e-4 == pytest.approx(g[at], rel=0.05, abs=1e-5), name


def test_next_id_probabilities_sum_to_one(random_model):
    ids, texts = np.full(A.VOCABULARY, 77), np.arange(A.VOCABULARY)
    logs = A.log_likelihoods(random_model, ids, texts, np.arange(A.VOCABULARY))
    assert np.exp(logs.astype(float)).sum() == pytest.approx(1, abs=1e-3)


def test_spelling_is_lossless_and_tells_words_apart():
    ranks = read_ranks()
    spell = S.speller(ranks, {})
    for word in ("hello", "ünï", "日本", "a", "'s"):
        ids = spell(word.encode())
        raw = bytes((i - A.FIRST_BYTE) % 256 for i in ids)
        assert raw.decode() == word
        assert [i - A.FIRST_BYTE >= 256 for i in ids] == [False] * (len(ids) - 1) + [True]


def test_report_equals_brute_force_and_beats_the_base(spark, monkeypatch):
    frame = read_table(spark, "/root/testdata/sf0.001", "documents")
    given = {r.doc_id: r.text for r in frame.collect()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in given}
    order = sorted(given)
    n, wanted = base([given[i] for i in order], [given[i] for i in order if not held[i]])
    monkeypatch.setattr(S.frequent, "__defaults__", (500,))
    found = {r.doc_id: r for r in S.lm_report(frame).collect()}
    for i, (tokens, known, score) in zip(order, wanted, strict=True):
        r = found[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], tokens, known, n)
        assert r.base_score == pytest.approx(score, rel=1e-9)
    assert sum(r.score for r in found.values() if r.held_out) > sum(r.base_score for r in found.values() if r.held_out)


def test_frequent_words_or_not_gives_the_same(spark, monkeypatch):
    frame = docs(spark, ["a b a", "b c", "A", None, "", "d e f g", "a a a a b"] * 3)
    first = {r.doc_id: (r.base_score, r.score) for r in S.lm_report(frame).collect()}
    monkeypatch.setattr(S.frequent, "__defaults__", (1,))
    again = {r.doc_id: (r.base_score, r.score) for r in S.lm_report(frame).collect()}
    for i, pair in first.items():
        assert pair == pytest.approx(again[i])


def test_nulls_repeats_long_nothing_learned_and_no_rows(spark):
    frame = docs(spark, [None, "", "long words " * 20_000], extra="'x' as base_score")
    frame = frame.unionByName(frame)
    found = S.lm_report(frame).collect()
    assert sorted(r.n_tokens for r in found) == [1, 1, 1, 1, 40_001, 40_001]
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in found)
    nothing = frame.filter(id_crc(frame.doc_id) % 5 == 1)
    assert all(r.n_known == 0 and r.train_tokens == 0 for r in S.lm_report(nothing).collect())
    assert S.lm_report(frame.filter("false")).count() == 0
    assert RANKS


def test_a_text_scores_the_same_alone_in_any_batch_and_as_a_copy(random_model):
    draw = np.random.default_rng(4)
    ids, wanted = draw.integers(0, A.VOCABULARY, (2, 300))
    other = draw.integers(0, A.VOCABULARY, 5)
    alone = A.text_log_likelihoods(random_model, ids, np.zeros(300, int), wanted)
    stream, marks = np.concatenate([other, ids, ids]), np.repeat([0, 1, 2], [5, 300, 300])
    batch = A.text_log_likelihoods(random_model, stream, marks, np.concatenate([other, wanted, wanted]))
    assert batch[5:305] == pytest.approx(alone, abs=1e-4) and batch[305:] == pytest.approx(alone, abs=1e-4)
    changed = ids.copy()
    changed[150] += 1 if changed[150] < A.VOCABULARY - 1 else -1
    assert A.text_log_likelihoods(random_model, changed, np.zeros(300, int), wanted)[290] != alone[290]


def test_every_training_text_teaches_the_model(spark, monkeypatch):
    monkeypatch.setattr(S, "STEPS", 8)
    texts = ["ab cd " * 30] * 500
    plain = docs(spark, texts)
    ranks = read_ranks()

    def taught(frame):
        return A.flat(S.fit(frame, ranks, 8)[0])

    first = taught(plain)
    assert taught(plain) == pytest.approx(first, abs=1e-6)
    for at in (3, 250, 499):
        changed = docs(spark, [*texts[:at], "cd ab ab " * 30, *texts[at + 1 :]])
        assert np.abs(taught(changed) - first).max() > 1e-6, at


def test_shards_of_a_larger_corpus_learn_what_one_does(spark, monkeypatch):
    monkeypatch.setattr(S, "BATCH", 512)
    frame = docs(spark, [f"the cat {i % 7} sat on the mat and the dog {i % 5} ran " * 6 for i in range(600)])
    model, known = S.fit(frame, read_ranks(), 60)
    spell = S.speller(read_ranks(), known)
    ids, marks, wanted = S._stream([[*map(spell, b"the cat 3 sat on the mat and the dog 4 ran".split()), [A.END]]])
    loss = -A.text_log_likelihoods(model, ids, marks, wanted)[2:-1].mean()
    assert loss < 1.5, loss


def test_large_scores_and_mixed_windows_equal_one_position_at_a_time(random_model):
    draw = np.random.default_rng(6)
    tables = {k: v * np.float32(30 if k in ("query", "key") else 1) for k, v in random_model.tables.items()}
    model = A.Model(random_model.place, tables)
    texts = np.repeat([0, 1, 2], [A.STEP, 2 * A.STEP + 40, 60])
    ids, wanted = draw.integers(0, A.VOCABULARY, (2, len(texts)))
    assert A.log_likelihoods(model, ids, texts, wanted) == pytest.approx(brute_logs(model, ids, texts, wanted), abs=1e-3)


def test_scoring_holds_the_weights_of_few_windows_at_a_time(random_model):
    n = A.STRETCH
    ids, texts = np.arange(n) % A.VOCABULARY, np.zeros(n, int)
    tracemalloc.start()
    A.log_likelihoods(random_model, ids, texts, ids)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 * n * 2 * A.STEP  # less than the weights of all windows, of which there were several copies


def test_positions_are_not_worked_on_with_rows_that_they_cannot_see(random_model):
    n = 8 * A.STEP
    ids = np.arange(n) % A.VOCABULARY

    def worked_on(texts):
        held = A._attend(random_model, ids, texts, keep=True)[-1]
        return sum(weight.size for *_, halves in held for _, weight in halves)

    # Half a window sees nothing of what follows it, and a text's first window nothing before it.
    assert worked_on(np.zeros(n, int)) <= 7 * n * 2 * A.STEP // 8
    assert worked_on(np.repeat(np.arange(8), A.STEP)) <= 3 * n * 2 * A.STEP // 8


def test_rows_are_added_by_id_however_often_an_id_comes():
    draw = np.random.default_rng(7)
    ids = np.concatenate([np.repeat(5, 300), np.repeat(np.arange(40, 60), np.arange(20)), draw.integers(0, A.VOCABULARY, 500)])
    draw.shuffle(ids)
    rows = draw.normal(size=(len(ids), 3))
    want = np.zeros((A.VOCABULARY, 3))
    np.add.at(want, ids, rows)
    assert A._added(rows, ids) == pytest.approx(want)
    assert not A._added(rows[:0], ids[:0]).any()


def test_predictions_from_large_scores_are_finite(random_model):
    tables = random_model.tables | {k: random_model.tables[k] * np.float32(400) for k in ("last", "classes", "members")}
    model = A.Model(random_model.place, tables)
    ids, texts = np.arange(200), np.zeros(200, int)
    logs = A.log_likelihoods(model, ids, texts, ids[::-1])
    assert logs == pytest.approx(brute_logs(model, ids, texts, ids[::-1]), rel=1e-3, abs=0.1) and logs.min() < -100
    loss, grads = A.gradients(model, ids, texts, ids[::-1])
    assert np.isfinite(loss) and all(np.isfinite(g).all() for g in grads.values())


def test_words_encoded_together_have_the_pieces_that_they_have_alone():
    encoding = S.encoding_of(read_ranks())
    spell = S.speller(read_ranks(), {(100, True): 600, (300, False): 601})
    plain = [b"the", b"don't", b"'s", "\u65e5\u672c".encode(), b"x1,2;", b"\xff\xfe", b"!?", b"the"]
    blanks = ["\u00a0a".encode(), b"a\x1cb", "a\u2003".encode(), "\u2028".encode()]
    calls = []
    for words in (plain, plain[:1], plain + blanks + plain, blanks):
        pieces, lengths = S.pieces_of(lambda text: calls.append(text) or encoding.encode_ordinary(text), words)
        alone = [encoding.encode_ordinary(w.decode("utf-8", "replace")) for w in words]
        assert [x.tolist() for x in np.split(pieces, np.cumsum(lengths)[:-1])] == alone
        ids, of_piece = spell.spelled(pieces, S.last_of(lengths))
        of_word = np.add.reduceat(of_piece, np.cumsum(lengths) - lengths)
        assert [x.tolist() for x in np.split(ids, np.cumsum(of_word)[:-1])] == [spell(w) for w in words]
        if words is plain:
            assert len(calls) <= 2  # not one call per word


def test_a_lexicon_that_begins_anew_spells_the_same(monkeypatch):
    ranks = read_ranks()
    texts = [[f"w{i % 50}x{i}".encode() for i in range(at, at + 40)] for at in range(0, 400, 20)] + [[]]
    spell = S.speller(ranks, {})
    want = [i for text in texts for ids in (*map(spell, text), [A.END]) for i in ids]
    for most in (S.REMEMBERED, 60, 1):
        monkeypatch.setattr(S, "REMEMBERED", most)
        lexicon = S.Lexicon(S.speller(ranks, {}), lambda keys: keys % 7)
        numbers = [lexicon.numbers([text]) for text in texts[:3]]
        assert lexicon.known.tolist() == (lexicon.keys % 7).tolist() and len(numbers[0]) == 41
        lexicon = S.Lexicon(S.speller(ranks, {}))
        assert [i for text in texts for i in lexicon.spelled(lexicon.numbers([text]))[0].tolist()] == want
        assert len(lexicon.slots) == len(lexicon.keys) <= max(most, 0) + 41 or most > 400
