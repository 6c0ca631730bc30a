"""Benchmark decontamination with a BM25 index of test items and block-max WAND.

The test items are the indexed collection, every passage of every training text is a query.
Passages are windows of twice the longest item of an index block, one item's length apart, so
that any occurrence of an item lies whole in one of them. An item is retrieved when a passage
has ``RETRIEVE`` or more of the item's own BM25 mass, and it is a leak when most of its
five-word shingles stand in the passage and its answer's words do, too.

Retrieval, per batch of texts: postings are in blocks of items with the largest impact per
term. Words that are common in queries and together never reach half the threshold of any
item are non-essential: a block's bound is its largest non-essential mass plus, over the
essential words of the passage, their block maxima. Blocks below the threshold are skipped;
in the others items are scored in full.

The items are dealt by hash into parts of about ``INDEX_ITEMS``; each part's index is broadcast
and passes over the texts by itself, so that memory is bounded however many items there are.

Edge cases: a null or empty text has no passages, a null or wordless item is not indexed;
items without five words are one shingle; repeated item or document rows give one pair; items
of equal text are pairs of their own; an empty table on either side gives no rows; columns
that clash with an output name are not read. Rows with a null doc_id are reported under null.
"""

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: BM25.
K1, B = 1.2, 0.75
#: Share of an item's own BM25 mass that a passage needs.
RETRIEVE = 0.4
#: Words of a shingle, and share of an item's shingles that makes a leak.
SHINGLE, OVERLAP = 5, 0.8
#: Share of the answer's words that must be there, too.
ANSWER = 0.5
#: Items of a block of postings, and of a part of the index.
BLOCK_ITEMS, INDEX_ITEMS = 16, 20_000

_WORD = re.compile(r"\w+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+")
PAIR = "doc_id long, item_id long, bm25 double, question_overlap double, answer_overlap double"


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """The words before the last sentence and those of it; one sentence is asked and answered by its halves."""
    sentences = [w for w in (words(s) for s in _SENTENCE.split(text)) if w]
    if len(sentences) > 1:
        return [w for s in sentences[:-1] for w in s], sentences[-1]
    only = sentences[0] if sentences else []
    return only[: (len(only) + 1) // 2], only[(len(only) + 1) // 2 :] or only


def shingles(of: list, n: int = SHINGLE) -> set:
    return {tuple(of[i : i + n]) for i in range(max(1, len(of) - n + 1))} if of else set()


@dataclass
class Item:
    item_id: int
    all: set
    question: set
    answer: set


class Index:
    """An impact-ordered index of one part of the items."""

    def __init__(self, items: list[tuple[int, str]], idf: dict[str, float], mean_length: float, common: list[str]):
        """``common``: words by the number of items that have them, the most frequent first."""
        split = [(item_id, text, words(text)) for item_id, text in items]
        self.items = []
        self.longest = max((len(w) for _, _, w in split), default=1)
        masses: list[dict[str, float]] = []
        for item_id, text, w in split:
            question, answer = question_and_answer(text)
            self.items.append(Item(item_id, shingles(w), shingles(question), set(answer)))
            counts: dict[str, int] = {}
            for x in w:
                counts[x] = counts.get(x, 0) + 1
            long = K1 * (1 - B + B * len(w) / mean_length)
            masses.append({x: idf[x] * n * (K1 + 1) / (n + long) for x, n in counts.items()})
        self.own = np.array([sum(m.values()) for m in masses])
        self.n_blocks = -(-len(split) // BLOCK_ITEMS)
        # Common words move to the non-essential side while no item exceeds half the threshold.
        spare = np.zeros(len(split))
        holders: dict[str, list[tuple[int, float]]] = {}
        for at, m in enumerate(masses):
            for x, impact in m.items():
                holders.setdefault(x, []).append((at, impact / self.own[at]))
        self.plain: set[str] = set()
        for x in common:
            post = holders.get(x, [])
            if all(spare[at] + share <= RETRIEVE / 2 for at, share in post):
                for at, share in post:
                    spare[at] += share
                self.plain.add(x)
        self.spare = np.array([spare[b * BLOCK_ITEMS : (b + 1) * BLOCK_ITEMS].max() for b in range(self.n_blocks)])
        self.number = {x: at for at, x in enumerate(holders)}
        self.essential = np.array([x not in self.plain for x in holders], bool)
        postings = [
            (np.array([at for at, _ in post]), np.array([share for _, share in post])) for post in holders.values()
        ]
        # Block maxima, by term from ``starts[term]`` on.
        starts, blocks, tops = [0], [], []
        for at, share in postings:
            own = at // BLOCK_ITEMS
            top = np.zeros(int(own[-1]) + 1)
            np.maximum.at(top, own, share)
            held = np.flatnonzero(top)
            blocks.append(held)
            tops.append(top[held])
            starts.append(starts[-1] + len(held))
        self.starts = np.array(starts)
        self.blocks = np.concatenate(blocks) if blocks else np.empty(0, int)
        self.tops = np.concatenate(tops) if tops else np.empty(0)
        # Postings once more by block, to score the block's items in full.
        term = np.repeat(np.arange(len(postings)), [len(at) for at, _ in postings])
        item = np.concatenate([at for at, _ in postings]) if postings else np.empty(0, int)
        share = np.concatenate([s for _, s in postings]) if postings else np.empty(0)
        order = np.argsort(item // BLOCK_ITEMS, kind="stable")
        edges = np.searchsorted(item[order] // BLOCK_ITEMS, np.arange(1, self.n_blocks))
        self.of_block = [
            (term[own], item[own] % BLOCK_ITEMS, share[own]) for own in np.split(order, edges)
        ]

    @property
    def postings(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Items and their shares by term; only the form by block is kept."""
        term, item, share = (
            np.concatenate(x)
            for x in zip(*((t, b * BLOCK_ITEMS + i, s) for b, (t, i, s) in enumerate(self.of_block)), strict=True)
        )
        order = np.argsort(term, kind="stable")
        edges = np.searchsorted(term[order], np.arange(1, len(self.number)))
        return list(zip(np.split(item[order], edges), np.split(share[order], edges), strict=True))

    def retrieve(self, tokens: list[str]) -> list[tuple[int, int, int, float]]:
        """(passage start, its end, item, BM25) of all items above the threshold."""
        number = self.number
        terms = np.fromiter((number.get(x, -1) for x in tokens), np.int64, len(tokens))
        places = np.flatnonzero(terms >= 0)
        places = places[self.essential[terms[places]]]
        if not len(places):
            return []
        step = self.longest
        # Each place lies in the passages that start one step before its own cell and in it.
        cell = places // step
        passage = np.concatenate([cell, cell - 1])
        term = np.concatenate([terms[places], terms[places]])
        keep = passage >= 0
        pairs = np.unique(passage[keep] * len(number) + term[keep])
        passage, term = pairs // len(number), pairs % len(number)
        n = self.starts[term + 1] - self.starts[term]
        at = np.repeat(self.starts[term] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        keys = np.repeat(passage, n) * self.n_blocks + self.blocks[at]
        held, where = np.unique(keys, return_inverse=True)
        bound = np.bincount(where, self.tops[at]) + self.spare[held % self.n_blocks]
        found = []
        there, now = np.zeros(len(number) + 1, bool), None  # by term; the last stands for unknown words
        for key in held[bound >= RETRIEVE - 1e-9]:
            start, block = int(key // self.n_blocks) * step, int(key % self.n_blocks)
            if start != now:
                there[:], now = False, start
                there[terms[start : start + 2 * step]] = True
            term, item, share = self.of_block[block]
            hit = there[term]
            scores = np.bincount(item[hit], share[hit], BLOCK_ITEMS)
            for i in np.flatnonzero(scores >= RETRIEVE - 1e-9):
                at = block * BLOCK_ITEMS + int(i)
                found.append((start, start + 2 * step, at, float(scores[i] * self.own[at])))
        return found

    def leaks(self, text: str | None) -> dict[int, tuple[float, float, float]]:
        """Per item that leaks into the text its best (BM25, question overlap, answer overlap)."""
        tokens = words(text)
        out: dict[int, tuple[float, float, float]] = {}
        for start, end, at, score in self.retrieve(tokens):
            item = self.items[at]
            passage = tokens[start:end]
            there = {}

            def share(of: set, passage=passage, there=there) -> float:
                if not of:
                    return 1.0
                n = len(next(iter(of)))
                if n not in there:
                    there[n] = shingles(passage, n)
                return len(of & there[n]) / len(of)

            if share(item.all) < OVERLAP:
                continue
            answered = len(item.answer & set(passage)) / len(item.answer)
            if answered >= ANSWER:
                best = (score, share(item.question), answered)
                out[item.item_id] = max(out.get(item.item_id, best), best)
        return out


def _split_items(batches):
    for batch in batches:
        found = [words(text) for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("item_id"), batch.column("text"), pa.array(found, pa.list_(pa.string()))],
            names=["item_id", "text", "words"],
        )


def index_parts(items: DataFrame, index_items: int = INDEX_ITEMS) -> Iterator[Index]:
    """The parts of the index, one after the other; document frequencies are over all items."""
    split = (
        items.filter("item_id is not null and text is not null")
        .select(F.col("item_id").cast("long").alias("item_id"), "text")
        .distinct()
        .mapInArrow(_split_items, "item_id long, text string, words array<string>")
        .filter("size(words) > 0")
    )
    n, mean = split.agg(F.count(F.lit(1)), F.avg(F.size("words"))).first()
    parts = -(-n // index_items)
    dealt = split.withColumn("_part", F.pmod(F.xxhash64("item_id"), F.lit(max(parts, 1))))
    frequency = (
        split.select(F.explode(F.array_distinct("words")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    )
    for part in range(parts):
        own = dealt.filter(F.col("_part") == part)
        vocabulary = own.select(F.explode("words").alias("word")).distinct()
        df = {r["word"]: r["df"] for r in frequency.join(vocabulary, "word").collect()}  # words of one part
        rows = sorted((r["item_id"], r["text"]) for r in own.select("item_id", "text").collect())
        idf = {word: math.log(1 + (n - d + 0.5) / (d + 0.5)) for word, d in df.items()}
        yield Index(rows, idf, float(mean), sorted(df, key=lambda word: (-df[word], word)))


def find_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Pairs ``doc_id``, ``item_id`` of all leaks, with the best BM25 and the overlaps.

    Every text is searched in the task that reads it; only the pairs found are shuffled.
    """
    session, texts = docs.sparkSession, docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = session.createDataFrame([], PAIR)
    for part in index_parts(items):
        index = session.sparkContext.broadcast(part)

        def search(batches, index=index):
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    some = batch.slice(at, 256)
                    rows = [
                        (doc_id, item_id, *best)
                        for doc_id, text in zip(
                            some.column("doc_id").to_pylist(), some.column("text").to_pylist(), strict=True
                        )
                        for item_id, best in index.value.leaks(text).items()
                    ]
                    columns = list(zip(*rows, strict=True)) or [[]] * 5
                    kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                        names=["doc_id", "item_id", "bm25", "question_overlap", "answer_overlap"],
                    )

        found = found.unionByName(texts.mapInArrow(search, PAIR))
    best = F.max(F.struct("bm25", "question_overlap", "answer_overlap")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")


def without_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents into which no item leaks; tested where they are read, without a shuffle."""
    def leaked_into(part: Index):
        index = docs.sparkSession.sparkContext.broadcast(part)

        @F.pandas_udf("boolean")
        def leaked(texts: pd.Series) -> pd.Series:
            return pd.Series([bool(index.value.leaks(text)) for text in texts], dtype=bool)

        return leaked(F.coalesce(F.col("text"), F.lit("")))

    clean = docs
    for part in index_parts(items):
        clean = clean.filter(~leaked_into(part))
    return clean
