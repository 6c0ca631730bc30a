"""Ranked lexical search: an Aho-Corasick scan of every document for the terms of all items.

The terms of the items stand in one automaton, each between two boundary marks, and texts are
rewritten so that every character that is no part of a term is such a mark. A scan of a text then
finds each occurrence of an item term as a whole term, and nothing else. Documents are never
indexed: a first scan counts documents, lengths and document frequencies, a second one scores and
keeps the best documents of each item in each task. What is shuffled are those few per task.

Items are taken in blocks whose terms fit the automaton's bound (``BLOCK_TERMS`` pairs of item and
term, checked before anything is sent to executors). Few items make one block; more blocks are
searched one after the other, each against all documents.

Edge cases: a null or empty text has no term and is no document of the statistics, an item without
a term or with a null text ranks nothing. Rows of items that share an id, a null id too, are one
item with all their terms. Rows of documents that repeat an id are documents of their own with
ranks of their own; a null id comes after all others at equal scores. Equal scores go by id, and rows
equal in both share out their ranks in any order. Texts are read whole at any length. Empty tables
give no rows. Other columns are not read, so that none can clash. One item with more than
``BLOCK_TERMS`` distinct terms is refused with a ValueError.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orgtrail.llm.common import at_rest, text_or_empty

#: Maximal runs of characters beyond ASCII, ASCII letters and digits: fixed by the contract.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP = 50
#: Pairs of item and term in an automaton, and the bytes of its terms.
BLOCK_TERMS, BLOCK_BYTES = 2_000_000, 64_000_000
#: Bytes of text scanned, and scores of documents and items held, at a time in a task.
SCAN_BYTES, SCORES = 1 << 20, 1 << 21
#: Groups of an item's candidates that are cut to the best before they meet.
PARTS = 32
#: Rows of the statistics that are no term.
DOCUMENTS, LENGTH = -1, -2

MARK = 0x20
#: Bytes of UTF-8 to bytes: A-Z lower-cased, all other ASCII but letters and digits a mark.
MARKED = bytes(
    b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else MARK for b in range(256)
)


@dataclass(frozen=True)
class Block:
    """The terms of a block of items, and for each term the items that have it."""

    terms: list[bytes]
    starts: np.ndarray
    items: np.ndarray
    ids: list

    def automaton(self) -> ahocorasick.Automaton:
        made = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, term in enumerate(self.terms):
            made.add_word(f" {term.decode('latin-1')} ", i)
        made.make_automaton()
        return made


def item_terms(items: DataFrame, id_: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct (item, term) pairs; upper-case A-Z is lower-cased."""
    lower = F.translate(
        text_or_empty(F.col(text)), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )
    found = F.regexp_extract_all(lower, F.lit(TERM), F.lit(0))
    return items.select(F.col(id_).alias("item"), F.explode(found).alias("term")).distinct()


def _n_blocks(pairs: DataFrame, most_terms: int, most_bytes: int) -> int:
    """Enough blocks of equal share; the largest item must fit one."""
    size = pairs.groupBy("item").agg(F.count("*").alias("n"), F.sum(F.octet_length("term")).alias("b"))
    found = size.agg(F.sum("n").alias("n"), F.sum("b").alias("b"), F.max("n").alias("most")).first()
    if not found["n"]:
        return 0
    if found["most"] > most_terms:
        raise ValueError(f"an item has {found['most']} terms, more than {most_terms}")
    share = max(found["n"] / most_terms, found["b"] / most_bytes)
    return 1 if share <= 1 else math.ceil(2 * share)


def _block(pairs: DataFrame, at: int, n: int) -> Block | None:
    """One block's terms on the driver, by its bound."""
    mine = pairs if n == 1 else pairs.filter(F.pmod(F.xxhash64("item"), F.lit(n)) == at)
    rows = sorted(mine.collect(), key=lambda row: row["term"].encode())
    if not rows:
        return None
    ids = sorted({row["item"] for row in rows}, key=lambda i: (i is None, i or 0))
    place = {i: at for at, i in enumerate(ids)}
    terms, starts = [], []
    for at, row in enumerate(rows):
        if not terms or terms[-1] != row["term"].encode():
            terms.append(row["term"].encode())
            starts.append(at)
    return Block(
        terms, np.array([*starts, len(rows)], np.int64), np.array([place[row["item"]] for row in rows], np.int64), ids
    )


def marked(text: bytes | None) -> bytes:
    """The text with marks for what is no term, and one before and behind it."""
    return b" " + (text or b"").translate(MARKED) + b" "


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    """The batch's marked texts in runs of about ``SCAN_BYTES``, with their first row."""
    first, texts, size = 0, [], 0
    for i, value in enumerate(batch.column(0)):
        texts.append(marked(value.as_py()))
        size += len(texts[-1])
        if size >= SCAN_BYTES:
            yield first, texts
            first, texts, size = i + 1, [], 0
    if texts:
        yield first, texts


def _occurrences(automaton, texts: list[bytes], n_terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, term, times) of the texts, in the documents' order, from one scan."""
    joined = b"".join(texts).decode("latin-1")
    flat = np.fromiter(chain.from_iterable(automaton.iter(joined)), dtype=np.int64)
    ends = np.cumsum([len(t) for t in texts])
    doc = np.searchsorted(ends, flat[0::2], side="right")
    keys, times = np.unique(doc * n_terms + flat[1::2], return_counts=True)
    return keys // n_terms, keys % n_terms, times.astype(np.int64)


def _statistics(docs: DataFrame, block) -> tuple[int, int, np.ndarray]:
    """N, L and the document frequencies of the block's terms, over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = block.value
        automaton, df = terms.automaton(), np.zeros(len(terms.terms), dtype=np.int64)
        some, length = 0, 0
        for batch in batches:
            for _, texts in _pieces(batch):
                lengths = [len(t.split()) for t in texts]
                some += sum(n > 0 for n in lengths)
                length += sum(lengths)
                _, term, _ = _occurrences(automaton, texts, len(df))
                df += np.bincount(term, minlength=len(df))
        used = np.flatnonzero(df)
        keys = np.concatenate([[DOCUMENTS, LENGTH], used])
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(np.concatenate([[some, length], df[used]]), pa.int64())], ["term", "n"]
        )

    df = np.zeros(len(block.value.terms), dtype=np.int64)
    whole = {DOCUMENTS: 0, LENGTH: 0}
    counted = docs.select("_text").mapInArrow(count, "term long, n long")
    for row in counted.groupBy("term").agg(F.sum("n").alias("n")).collect():
        if row["term"] < 0:
            whole[row["term"]] = row["n"]
        else:
            df[row["term"]] = row["n"]
    return whole[DOCUMENTS], whole[LENGTH], df


def term_weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    """floor(1000 * ln((2N + 2) / (2df + 1))) by term."""
    ratio = np.array([(2 * n_docs + 2) / (2 * int(d) + 1) for d in df])
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


@dataclass
class Best:
    """The best documents of each item among those that a task has seen."""

    n_items: int
    top: int

    def __post_init__(self) -> None:
        self.least = np.zeros(self.n_items, dtype=np.int64)
        self.held = [np.empty(0, dtype=np.int64) for _ in range(4)]

    def add(self, item: np.ndarray, score: np.ndarray, null: np.ndarray, doc: np.ndarray) -> None:
        self.held = [np.concatenate(pair) for pair in zip(self.held, (item, score, null, doc))]
        if len(self.held[0]) > 4 * self.top * self.n_items:
            self.cut()

    def cut(self) -> None:
        item, score, null, doc = self.held
        order = np.lexsort((doc, null, -score, item))
        item, score = item[order], score[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        last = rank == self.top - 1
        self.least[item[last]] = score[last]
        kept = rank < self.top
        self.held = [item[kept], score[kept], null[order][kept], doc[order][kept]]


def _scores(block: Block, weights: np.ndarray, m: np.ndarray, found, low: int, high: int) -> np.ndarray:
    """(documents, items) scores of documents ``low`` to ``high``."""
    doc, term, times = found
    here = slice(*np.searchsorted(doc, [low, high]))
    doc, term, times = doc[here], term[here], times[here]
    gain = weights[term] * ((1_000_000_000 * times) // (1000 * times + 20 * m[doc]))
    n = block.starts[term + 1] - block.starts[term]
    ahead = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    item = block.items[np.repeat(block.starts[term], n) + ahead]
    scores = np.zeros((high - low) * len(block.ids), dtype=np.int64)
    np.add.at(scores, np.repeat(doc - low, n) * len(block.ids) + item, np.repeat(gain, n))
    return scores.reshape(high - low, -1)


def _best_of(docs: DataFrame, block, n_docs: int, length: int, weights: np.ndarray, top: int) -> DataFrame:
    """(item, doc_id, score) of the best documents of each item in each task."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = block.value
        automaton, best = terms.automaton(), Best(len(terms.ids), top)
        step = max(1, SCORES // len(terms.ids))
        for batch in batches:
            null = batch.column(1).is_null().to_numpy(zero_copy_only=False).astype(np.int64)
            ids = batch.column(1).fill_null(0).to_numpy()
            for first, texts in _pieces(batch):
                lengths = [len(t.split()) for t in texts]
                m = np.array([100 - 50 + (50 * n * n_docs) // max(length, 1) for n in lengths], dtype=np.int64)
                found = _occurrences(automaton, texts, len(terms.terms))
                for low in range(0, len(texts), step):
                    scores = _scores(terms, weights, m, found, low, min(low + step, len(texts)))
                    row, item = np.nonzero((scores > 0) & (scores >= best.least))
                    at = first + low + row
                    best.add(item, scores[row, item], null[at], ids[at])
        best.cut()
        item, score, null, doc = best.held
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int64()), pa.array(doc, pa.int64(), mask=null.astype(bool)), pa.array(score, pa.int64())],
            ["item", "doc_id", "score"],
        )

    return docs.select("_text", "_doc").mapInArrow(search, "item long, doc_id long, score long")


def _top_of(found: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of each item, cut in groups of its candidates first."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    inside = Window.partitionBy("item", "_part").orderBy(*order)
    whole = Window.partitionBy("item").orderBy(*order)
    part = F.pmod(F.xxhash64("doc_id", "score"), F.lit(PARTS))
    few = found.withColumn("_part", part).withColumn("_rank", F.row_number().over(inside)).filter(F.col("_rank") <= top)
    return few.drop("_part", "_rank").withColumn("rank", F.row_number().over(whole)).filter(F.col("rank") <= top)


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
    block_terms: int = BLOCK_TERMS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score`` of each item's best documents."""
    spark = docs.sparkSession
    pairs = at_rest(item_terms(items, item_id, text), "item-terms")
    texts = docs.select(F.col(text).cast("binary").alias("_text"), F.col(doc_id).cast("long").alias("_doc"))
    id_type = items.schema[item_id].dataType.simpleString()
    results, n = [], _n_blocks(pairs, block_terms, block_bytes)
    for at in range(n):
        block = _block(pairs, at, n)
        if block is None:
            continue
        sent = spark.sparkContext.broadcast(block)
        n_docs, length, df = _statistics(texts, sent)
        best = _top_of(_best_of(texts, sent, n_docs, length, term_weights(n_docs, df), top), top)
        named = spark.createDataFrame(list(enumerate(block.ids)), f"item long, item_id {id_type}")
        result = best.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score")
        if n > 1:
            result = at_rest(result, "ranked")
            sent.unpersist()
        results.append(result)
    if not results:
        return spark.createDataFrame([], f"item_id {id_type}, rank int, doc_id long, score long")
    made = results[0]
    for more in results[1:]:
        made = made.unionByName(more)
    return made


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE = f"""
with words as (
  select doc_id, rid, unnest(regexp_extract_all({_LOWER.format('text')}, '{TERM}')) as term
  from (select *, row_number() over () as rid from documents) d),
items as (
  select distinct item_id, unnest(regexp_extract_all({_LOWER.format('text')}, '{TERM}')) as term from benchmark),
lengths as (select doc_id, rid, cast(count(*) as bigint) as n from words group by doc_id, rid),
whole as (select cast(count(*) as bigint) as docs, cast(sum(n) as bigint) as words from lengths),
counts as (
  select rid, term, cast(count(*) as bigint) as tf from words
  where term in (select term from items) group by rid, term),
weights as (
  select term, cast(floor(1000 * ln(cast(2 * docs + 2 as double) / cast(2 * df + 1 as double))) as bigint) as w
  from (select term, count(*) as df from counts group by term) f, whole),
scored as (
  select item_id, doc_id, rid, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + ((50 * n * docs) // words))))) as bigint) as score
  from counts join lengths using (rid) join weights using (term) join items using (term), whole
  group by item_id, doc_id, rid),
ranked as (
  select *, cast(row_number() over (partition by item_id order by score desc, doc_id nulls last) as int) as rank
  from scored where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= {TOP}"""
