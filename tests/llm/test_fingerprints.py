import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F
from tests.llm.build import docs

from orgtrail.llm import fingerprints as P

IDEOGRAPHS = "一-鿿"  # enough of the scripts without blanks for these tests


def brute_tokens(text):
    return re.findall(rf"[{IDEOGRAPHS}]|[^\x20\x09-\x0D{IDEOGRAPHS}]+", text)


class Hashes:
    """The engine's hashes of tokens and of runs of them, asked for once."""

    def __init__(self, spark, texts, k=P.K, s=P.S):
        words = sorted({w for t in texts for w in brute_tokens(t)}) or [""]
        frame = spark.createDataFrame([(w,) for w in words], "w string")
        self.word = {r.w: r.h for r in frame.select("w", F.xxhash64("w").alias("h")).collect()}
        runs = set()
        for t in texts:
            h = [self.word[w] for w in brute_tokens(t)]
            sizes = (k, s) if len(h) >= k else ()
            runs |= {tuple(h[i : i + n]) for n in sizes for i in range(len(h) - n + 1)} | ({tuple(h)} if h and not sizes else set())
        self.run = {}
        for n in {len(r) for r in runs}:
            own = [r for r in runs if len(r) == n]
            frame = spark.createDataFrame([(list(r),) for r in own], "a array<bigint>")
            value = F.xxhash64(*[F.col("a")[j] for j in range(n)]) if n in (k, s) else F.xxhash64("a")
            if n == s and s < k:  # a whole text of s tokens is hashed as an array
                whole = dict(frame.select(F.to_json("a"), F.xxhash64("a")).collect())
                self.short = {r: whole["[" + ",".join(map(str, r)) + "]"] % (1 << 64) >> 16 for r in own}
            found = dict(frame.select(F.to_json("a"), value).collect())
            self.run |= {r: found["[" + ",".join(map(str, r)) + "]"] % (1 << 64) >> 16 for r in own}

    def anchors(self, text, k=P.K, s=P.S):
        """(hash, position) by definition, all of them in order."""
        h = [self.word[w] for w in brute_tokens(text)]
        if not h:
            return []
        if len(h) < k:
            return [(self.short[tuple(h)] if len(h) == s else self.run[tuple(h)], 0)]
        out = []
        for i in range(len(h) - k + 1):
            inner = [self.run[tuple(h[j : j + s])] for j in range(i, i + k - s + 1)]
            if min(inner) in (inner[0], inner[-1]):
                out.append((self.run[tuple(h[i : i + k])], i))
        return out


def first_at(found):
    at = {}
    for h, i in found:
        at.setdefault(h, i)
    return at


def brute_print(at):
    return "".join(f"{h:012X}{i:08X}" for h, i in sorted(at.items()))


def brute_likeness(a, b, n_a, n_b):
    if not a and not b:
        return 1.0
    slack = int(max(n_a, n_b) * P.SLACK)
    low, high = min(0, n_b - n_a) - slack, max(0, n_b - n_a) + slack
    return sum(low <= b[h] - a[h] <= high for h in a.keys() & b.keys()) / len(a.keys() | b.keys())


def brute_passage(a, b, n, k=P.K):
    """The longest stretch that anchors of one offset cover without a gap."""
    best = (0, 0, 0)
    by_shift = {}
    for h in a.keys() & b.keys():
        by_shift.setdefault(b[h] - a[h], set()).add(a[h])
    for shift in sorted(by_shift):
        for at in sorted(by_shift[shift]):
            end = at + k
            while (on := [x for x in by_shift[shift] if at < x <= end and x + k > end]):
                end = max(on) + k
            if end - at > best[2]:
                best = (at, at + shift, end - at)
    return best[0], best[1], min(best[2], n)


WORDS = ["alpha", "béta", "γάμμα", "the", "of", "😀x", "ion\n", "re", "漢字の", "of,the"]


def test_report_equals_brute_force(spark):
    draw = random.Random(1)
    texts = [" ".join(draw.choice(WORDS) for _ in range(n)) for n in (1, 2, 3, 4, 5, 6, 9, 40, 300, 40)]
    texts += ["", None, " \t\n", "abc", "漢字漢字漢字漢", "a a a a a a a a a a a a", texts[8], texts[8][100:]]
    known = [t or "" for t in texts]
    after = [*known[1:], known[0]]
    edited = [t[: len(t) - len(t) // 4] + n[: len(t) // 4] for t, n in zip(known, after, strict=True)]
    hashes = Hashes(spark, known + edited)
    frame = docs(spark, texts, extra="'x' as sha")
    found = {r.doc_id: r for r in P.fingerprint_edits(frame, ranges=4).collect()}
    own = [first_at(hashes.anchors(t)) for t in known]
    n = [len(brute_tokens(t)) for t in known]
    assert len(found) == len(texts)
    for i, r in found.items():
        then = (i + 1) % len(texts)
        new = first_at(hashes.anchors(edited[i]))
        assert r.n_chars == len(known[i])
        assert r.edited_sha256 == hashlib.sha256(edited[i].encode()).hexdigest()
        assert r.fingerprint == brute_print(own[i])
        assert r.edited_fingerprint == brute_print(new)
        assert r.near_edited == pytest.approx(brute_likeness(own[i], new, n[i], len(brute_tokens(edited[i]))))
        assert r.near_next == pytest.approx(brute_likeness(own[i], own[then], n[i], n[then]))
        assert (r.passage_at, r.passage_next_at, r.passage_tokens) == brute_passage(own[i], own[then], n[i])
    assert found[8].fingerprint == found[16].fingerprint != found[9].fingerprint


def prose(draw, n):
    return [f"w{draw.randrange(100_000)}" for _ in range(n)]


def test_positions_decide(spark):
    """Paragraphs in another order aren't alike, an insertion is; a shared passage is found where it stands."""
    draw = random.Random(2)
    parts = [" ".join(prose(draw, 60)) for _ in range(20)]
    text, turned = "\n".join(parts), "\n".join(reversed(parts))
    put_in = "\n".join([*parts[:10], " ".join(prose(draw, 50)), *parts[10:]])
    passage = " ".join(prose(draw, 60))
    long = [" ".join([*prose(draw, a), passage, *prose(draw, 3000 - a)]) for a in (700, 2100)]
    rows = P.fingerprint_edits(docs(spark, [turned, text, put_in, *long])).orderBy("doc_id").collect()
    assert rows[0].near_next < 0.2
    assert rows[1].near_next > 0.9
    assert rows[2].near_next == 0
    assert rows[3].near_next < 0.05
    assert 55 <= rows[3].passage_tokens <= 60
    assert 700 <= rows[3].passage_at <= 703 and rows[3].passage_next_at - rows[3].passage_at == 1400


def test_some_anchor_in_every_window(spark):
    """Of k - s neighbouring k-mers one is chosen, so a shared run of 2k - s - 1 tokens is seen."""
    text = " ".join(prose(random.Random(3), 2000))
    (r,) = docs(spark, [text]).select(P.anchors(P.tokens(F.col("text")))["at"].alias("at")).collect()
    assert max(b - a for a, b in zip(r["at"], r["at"][1:], strict=False)) <= P.K - P.S
    assert len(r["at"]) < 0.6 * 2000


def next_of(spark, ids, ranges):
    """doc_id and the text whose head each row's edit takes; texts name their ids."""
    rows = [(i, f"{'n' if i is None else i};" * 40) for i in ids]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return rows, P.fingerprint_edits(frame, ranges=ranges).select("doc_id", "edited_sha256").collect()


def edited_sha(text, following):
    cut = len(text) // 4
    return hashlib.sha256((text[: len(text) - cut] + following[:cut]).encode()).hexdigest()


@pytest.mark.parametrize("ranges", [1, 3, 64])
def test_order_of_ids_across_ranges(spark, ranges):
    ids = [5, -3, 1 << 40, 7, 8, 9, 100, 101, -(1 << 63), (1 << 63) - 1]
    rows, found = next_of(spark, ids, ranges)
    text = dict(rows)
    order = sorted(ids)
    then = dict(zip(order, [*order[1:], order[0]], strict=True))
    assert {r.doc_id: r.edited_sha256 for r in found} == {i: edited_sha(text[i], text[then[i]]) for i in ids}


@pytest.mark.parametrize("hot", [4, None])
def test_hot_id_is_dealt_to_several_tasks(spark, hot):
    ids = [1, 2, 3, 5, 6] + [hot] * 60
    rows = [(i, f"{i} {n} " * 9 if i == hot else f"{i};" * 40) for n, i in enumerate(ids)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    tasks = P.beside_next(frame, 8).filter(F.col("doc_id").eqNullSafe(F.lit(hot)) & ~F.col("_guest"))
    assert tasks.select("_range", "_task").distinct().count() > 3
    first = {}
    for i, text in rows:
        by_sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        first[i] = min(first.get(i, text), text, key=by_sha)
    order = [1, 2, 3, *([hot] if hot else []), 5, 6]
    then = dict(zip(order, [*order[1:], order[0]], strict=True)) | {None: 1}
    wanted = sorted((str(i), edited_sha(text, first[then[i]])) for i, text in rows)
    found = P.fingerprint_edits(frame, ranges=8).select("doc_id", "edited_sha256").collect()
    assert sorted((str(r.doc_id), r.edited_sha256) for r in found) == wanted


def test_nulls_repeats_single_and_no_rows(spark):
    schema = "doc_id long, text string"
    frame = spark.createDataFrame([(None, "the null one is here"), (1, "first of two texts"), (1, "second of two texts"), (9, "the last of all texts")], schema)
    found = P.fingerprint_edits(frame).collect()
    assert len(found) == 4
    first = min(("first of two texts", "second of two texts"), key=lambda t: hashlib.sha256(t.encode()).hexdigest())
    for r in found:
        if r.doc_id != 1:
            text = {None: "the null one is here", 9: "the last of all texts"}[r.doc_id]
            assert r.edited_sha256 == edited_sha(text, first)
    for only in ("doc_id = 9", "doc_id is null"):
        alone = P.fingerprint_edits(frame.filter(only)).collect()
        assert [r.near_next for r in alone] == [1.0]
    assert P.fingerprint_edits(frame.filter("false")).count() == 0


def test_long_text(spark):
    text = " ".join(f"w{i}" for i in range(20_000))
    (r,) = P.fingerprint_edits(docs(spark, [text])).collect()
    assert r.n_chars == len(text) and len(r.fingerprint) > 20 * 0.4 * 20_000 and 0.5 < r.near_edited < 0.9
    assert (r.near_next, r.passage_at) == (1.0, 0) and r.passage_tokens > 19_990
