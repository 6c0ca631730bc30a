"""LM scoring: log probabilities of whole texts under a causal self-attention model.

The model (``attention``) learns in numpy from the subword ids of every training text. Pieces and
which id follows which are counted over all of them. Texts are then dealt by a hash of id and text to
shards of about ``STEPS`` steps; each shard's task trains the same fresh model on all its texts, in
the order of that hash, and the trained models are averaged by their ids. A corpus that is smaller than one
shard is gone over again until ``STEPS`` are taken. Its probability of a word, the product over the word's pieces,
is mixed with the word's smoothed share of the training corpus, which is counted over all of it:
``p(word) = MODEL_SHARE * p(pieces | what stands before) + (1 - MODEL_SHARE) * share``, with
``share = (count + 0.5) / (all + 0.5 * (types + 1))``. Each text ends with an end token. As in
the base score, the words that training lacks are one outcome of the vocabulary; over the
known words and that one the mixture sums to at most 1, so both scores are of the same kind.

Counts of the ``FREQUENT`` most frequent words (a bound on rows) are broadcast. All other words
of a text are joined with their counts by a shuffle on the word's hash, one row per
occurrence, and summed by text; none of these words is frequent, so no key is hot. The counts
are written to the shared folder first. Words go by 64-bit hashes.

Edge cases: a null text is an empty one and has its end token only; without training texts
nothing is known, N and V are 0 and the base score is that of its formula with N = V = 0;
null ids belong to the part that the CRC-32 of the empty text gives; repeated rows are counted
and scored each; an empty table gives no rows; columns that clash with an output name are not
read.
"""

from collections import Counter
from itertools import chain, islice

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orgtrail.llm import attention as A
from orgtrail.llm.common import at_rest, id_crc
from orgtrail.llm.token_counts import PATTERN, RANKS, read_ranks

#: Steps of a shard and positions of a step.
STEPS, BATCH = 500, 4096
#: Parameters of a row when models are averaged.
BLOCK = 2048
#: Weight of the attention model in a word's probability.
MODEL_SHARE = 0.3
#: Words whose counts are broadcast, at most.
FREQUENT = 200_000
#: Different words, and bytes of texts or of words, that a worker holds before it passes them on or forgets them.
REMEMBERED, HELD = 300_000, 1 << 25

#: The end of a text counts as a word; no word is empty.
END_KEY = xxhash.xxh64_intdigest(b"")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()


def _keys(words) -> np.ndarray:
    """Hashes of words."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64)


def _counted(batches):
    """Different words of some texts with their counts, and how many texts these were."""
    seen: Counter = Counter()
    held = texts = 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            for text in batch.slice(at, 256).column("text").to_pylist():
                seen.update(words_of(text))
                held += len(text or "")
                texts += 1
                if len(seen) >= REMEMBERED or held >= HELD:
                    yield seen, texts
                    seen, held, texts = Counter(), 0, 0
    if texts:
        yield seen, texts


def _count_rows(batches):
    for seen, texts in _counted(batches):
        keys = np.append(_keys(seen), np.uint64(END_KEY))
        n = np.append(np.fromiter(seen.values(), np.int64, len(seen)), texts)
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], names=["key", "n"])


def word_counts(docs: DataFrame) -> DataFrame:
    """``key`` and its count ``n`` over all texts, ends included; written to the shared folder."""
    counts = docs.select("text").mapInArrow(_count_rows, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    return at_rest(counts, "word-counts")


def frequent(counts: DataFrame, most: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """Keys, sorted, and counts of words of at least some count; ``most`` words at most."""
    by_count = sorted(map(tuple, counts.groupBy("n").count().collect()), reverse=True)  # distinct counts
    total, least = 0, None
    for n, words in by_count:
        total += words
        if total > most:
            break
        least = n
    if least is None:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    rows = counts.filter(F.col("n") >= least).toPandas()
    keys = rows["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], rows["n"].to_numpy(np.int64)[order]


def encoding_of(ranks: dict[bytes, int]) -> tiktoken.Encoding:
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def speller(ranks: dict[bytes, int], known: dict[tuple[int, bool], int]) -> A.Speller:
    encoding = encoding_of(ranks)
    return A.Speller(encoding.encode_ordinary, encoding.decode_single_token_bytes, known)


def pieces_of(encode, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of words in a row, and how many each word has.

    The encoder gets them in one text, parted by line ends. These join with nothing that is no blank, so that a
    word has the pieces that it has alone; words with blanks of other scripts in them are encoded alone.
    """
    texts = [word.decode("utf-8", "replace") for word in words]
    alone = np.zeros(len(texts), bool)
    together = "\n".join(texts)
    if together.split() != texts:
        alone = np.array([text.split() != [text] for text in texts], bool)
        together = "\n".join(text for text, odd in zip(texts, alone, strict=True) if not odd)
    (line_end,) = encode("\n")
    pieces = np.array(encode(f"{together}\n"), np.int64) if together else np.empty(0, np.int64)
    ends = np.flatnonzero(pieces == line_end)
    odd = [encode(texts[at]) for at in np.flatnonzero(alone)]
    lengths = np.empty(len(texts), np.int64)
    lengths[~alone] = np.diff(ends, prepend=-1) - 1
    lengths[alone] = np.fromiter(map(len, odd), np.int64, len(odd))
    pieces = np.concatenate([pieces[pieces != line_end], np.fromiter(chain.from_iterable(odd), np.int64)])
    order = np.argsort(alone, kind="stable")
    starts = np.empty(len(texts), np.int64)
    starts[order] = np.cumsum(lengths[order]) - lengths[order]
    return A.ragged(pieces, starts, lengths)


def last_of(lengths: np.ndarray) -> np.ndarray:
    """Whether a piece is the last of its word."""
    last = np.zeros(int(lengths.sum()), bool)
    last[np.cumsum(lengths) - 1] = True
    return last


class _Slots(dict):
    """A number for each word, given when it is first asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = at = len(self)
        return at


class Lexicon:
    """What is known of words, by slot: their hashes and their ids, which stand in a row.

    Slot 0 is the end of a text. When it has ``REMEMBERED`` words, or ``HELD`` bytes of them, it begins anew before the
    next texts.
    """

    def __init__(self, speller: A.Speller, about=None):
        """``about``: what else is to be known, an array made of an array of hashes."""
        self.speller, self.about = speller, about or (lambda keys: keys)
        self._begin()

    def _begin(self) -> None:
        self.slots, self.held = _Slots(), 0
        self.keys, self.ids = np.empty(0, np.uint64), np.empty(0, np.int16)
        self.starts, self.lengths = np.empty((2, 0), np.int64)
        self.known = self.about(self.keys)
        self.slots[b""]
        self._add([b""], np.array([A.END]), np.ones(1, np.int64))

    def _add(self, words: list[bytes], ids: np.ndarray, lengths: np.ndarray) -> None:
        keys = _keys(words)
        self.held += sum(map(len, words))
        self.starts = np.append(self.starts, len(self.ids) + np.cumsum(lengths) - lengths)
        self.lengths = np.append(self.lengths, lengths)
        self.ids = np.append(self.ids, ids.astype(np.int16))
        self.keys, self.known = np.append(self.keys, keys), np.append(self.known, self.about(keys))

    def _learn(self) -> None:
        """Takes in the words that have a slot only."""
        words = [*islice(self.slots, len(self.keys), None)]
        pieces, lengths = pieces_of(self.speller.encode, words)
        ids, of_piece = self.speller.spelled(pieces, last_of(lengths))
        self._add(words, ids, np.add.reduceat(of_piece, np.cumsum(lengths) - lengths))

    def numbers(self, texts: list[list[bytes]]) -> np.ndarray:
        """Slots of the texts' words, each text followed by its end."""
        if len(self.slots) >= REMEMBERED or self.held >= HELD:
            self._begin()
        words = [w for text in texts for w in (*text, b"")]
        out = np.fromiter(map(self.slots.__getitem__, words), np.int64, len(words))
        if len(self.slots) > len(self.keys):
            self._learn()
        return out

    def spelled(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words in a row, and how many each word has."""
        ids, spans = A.ragged(self.ids, self.starts.take(numbers), self.lengths.take(numbers))
        return ids.astype(np.int64), spans


def _behind(wanted: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The input ids of texts of so many ids: what stands before each wanted one."""
    ids = np.concatenate([[A.BEGIN], wanted[:-1]])
    ids[np.cumsum(lengths) - lengths] = A.BEGIN
    return ids


def _stream(texts: list[list[list[int]]]):
    """Input ids, text numbers and wanted ids of texts, each given as its words' ids."""
    wanted = np.array([i for words in texts for ids in words for i in ids], np.int64)
    lengths = np.array([sum(map(len, words)) for words in texts])
    return _behind(wanted, lengths), np.repeat(np.arange(len(texts)), lengths), wanted


def _texts(batches, most: int = 64):
    """Lists of texts, each as its words."""
    for batch in batches:
        for at in range(0, batch.num_rows, most):
            yield [words_of(text) for text in batch.slice(at, most).column("text").to_pylist()]


def _piece_rows(shared):
    def rows(batches):
        encoding = encoding_of(shared.value)
        seen = np.zeros(2 * (encoding.max_token_value + 1), np.int64)
        for words, _ in _counted(batches):
            if words:
                pieces, lengths = pieces_of(encoding.encode_ordinary, [*words])
                counts = np.fromiter(words.values(), np.int64, len(words))
                np.add.at(seen, 2 * pieces + last_of(lengths), np.repeat(counts, lengths))
        found = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found // 2), pa.array(found % 2 == 1), pa.array(seen[found])], names=["piece", "final", "n"]
        )

    return rows


def _streams(batches, ranks, known):
    """Input ids, text numbers and wanted ids of some texts at a time."""
    lexicon = Lexicon(speller(ranks, known))
    for texts in _texts(batches):
        wanted, spans = lexicon.spelled(lexicon.numbers(texts))
        words = np.array([len(text) + 1 for text in texts])
        lengths = np.add.reduceat(spans, np.cumsum(words) - words)
        yield _behind(wanted, lengths), np.repeat(np.arange(len(texts)), lengths), wanted


def _follow_rows(shared):
    def rows(batches):
        follow = np.zeros(A.VOCABULARY**2, np.int64)
        for ids, _, wanted in _streams(batches, *shared.value):
            np.add.at(follow, ids * A.VOCABULARY + wanted, 1)
        pairs = np.flatnonzero(follow)
        for at in range(0, len(pairs), 65_536):
            part = pairs[at : at + 65_536]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(follow[part])], names=["pair", "n"])

    return rows


def _train_rows(shared):
    """The parameters that a shard's texts give, in blocks, with the number of ids learned from."""

    def rows(batches):
        model, known, ranks, steps, again = shared.value
        model = A.Model(model.place, {k: v.copy() for k, v in model.tables.items()})
        adam = A.Adam(model, steps)
        waiting, held, learned, read = np.empty((3, 0), np.int64), [], 0, 0
        for ids, marks, wanted in _streams(batches, ranks, known):
            learned += len(ids)
            at, n = A.aligned(np.bincount(marks))
            placed = [A.spread(ids, at, n, A.BEGIN), A.spread(marks + read, at, n, -1), A.spread(wanted, at, n, A.BEGIN)]
            read += int(marks[-1]) + 1
            waiting = np.concatenate([waiting, placed], axis=1)
            while waiting.shape[1] >= BATCH:
                part, waiting = waiting[:, :BATCH], waiting[:, BATCH:]
                adam.step(*part)
                if again:  # less than a shard in all
                    held.append(part)
        if waiting.shape[1]:
            adam.step(*waiting)
            held.append(waiting)
        draw = np.random.default_rng(13)
        while again and held and adam.taken < steps:
            for at in draw.permutation(len(held))[: steps - adam.taken]:
                adam.step(*held[at])
        if learned:
            values = A.flat(model)
            blocks = range(0, len(values), BLOCK)
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([at // BLOCK for at in blocks], pa.int32()),
                    pa.array([part] * len(blocks), pa.int32()),
                    pa.array([learned] * len(blocks), pa.int64()),
                    pa.array([values[at : at + BLOCK].tobytes() for at in blocks], pa.binary()),
                ],
                names=["block", "part", "learned", "weights"],
            )

    return rows


def _average(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("part")
    values = np.stack([np.frombuffer(x, np.float32) for x in rows["weights"]])
    mean = np.average(values.astype(np.float64), axis=0, weights=rows["learned"])
    return pd.DataFrame({"block": [rows["block"].iloc[0]], "weights": [mean.astype(np.float32).tobytes()]})


def fit(learn: DataFrame, ranks: dict[bytes, int], steps: int = STEPS) -> tuple[A.Model, dict[tuple[int, bool], int]]:
    """The trained model and its vocabulary, from all texts of ``learn``; the driver sees tables of the model's size."""
    context = learn.sparkSession.sparkContext
    texts = learn.select(F.col("doc_id").cast("string").alias("doc_id"), "text").filter("text is not null")
    pieces = texts.select("text").mapInArrow(_piece_rows(context.broadcast(ranks)), "piece long, final boolean, n long")
    room = A.VOCABULARY - A.FIRST_BYTE - 512
    best = pieces.groupBy("piece", "final").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece", "final").limit(room).collect()
    known = {(r["piece"], r["final"]): A.FIRST_BYTE + 512 + i for i, r in enumerate(best)}
    pairs = texts.select("text").mapInArrow(_follow_rows(context.broadcast((ranks, known))), "pair int, n long")
    found = pairs.groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    follow = np.zeros(A.VOCABULARY**2, np.int64)
    follow[found["pair"].to_numpy()] = found["n"].to_numpy()
    follow = follow.reshape(A.VOCABULARY, -1)
    model, ids = A.fresh_model(follow.sum(axis=0), follow), int(follow.sum())
    shards = max(1, -(-ids // (steps * BATCH)))
    shared = context.broadcast((model, known, ranks, steps, ids < steps * BATCH))
    mark = F.xxhash64("doc_id", "text")
    dealt = texts.withColumn("mark", mark).repartition(shards, "mark").sortWithinPartitions("mark", "doc_id", "text")
    trained = dealt.select("text").mapInArrow(_train_rows(shared), "block int, part int, learned long, weights binary")
    blocks = trained.groupBy("block").applyInPandas(_average, "block int, weights binary").collect()
    if not blocks:
        return model, known
    values = b"".join(bytes(r["weights"]) for r in sorted(blocks, key=lambda r: r["block"]))
    return A.shaped(np.frombuffer(values, np.float32), model), known


SCORED = "rid long, doc_id long, key long, is_text boolean, n_tokens long, n_known long, base double, lm double"


def _score_rows(shared):
    """One row per text with what its frequent words give, and one per occurrence of another word."""

    def rows(batches):
        model, known, ranks, keys, counts, total, types = shared.value
        floor = np.log10(total + 0.5 * (types + 1))

        def count_of(hashed):
            """Counts of frequent words, -1 for others."""
            if not len(keys):
                return np.full(len(hashed), -1, np.int64)
            slot = np.minimum(np.searchsorted(keys, hashed), len(keys) - 1)
            return np.where(keys[slot] == hashed, counts[slot], -1)

        lexicon = Lexicon(speller(ranks, known), count_of)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                texts = [words_of(text) for text in part.column("text").to_pylist()]
                lengths = np.array([len(t) + 1 for t in texts])
                numbers = lexicon.numbers(texts)
                wanted, spans = lexicon.spelled(numbers)
                owner = np.repeat(np.arange(len(texts)), lengths)
                starts = np.cumsum(spans) - spans
                ids = _behind(wanted, np.add.reduceat(spans, np.cumsum(lengths) - lengths))
                logs = A.text_log_likelihoods(model, ids, np.repeat(owner, spans), wanted)
                lm = np.add.reduceat(logs.astype(np.float64), starts)
                hashed, n = lexicon.keys.take(numbers), lexicon.known.take(numbers)
                held = n >= 0
                n = np.maximum(n, 0)
                base = np.log10(n + 0.5) - floor
                score = np.log10(MODEL_SHARE * np.exp(lm) + (1 - MODEL_SHARE) * 10**base)
                by_text = lambda x, owner=owner, held=held: np.bincount(owner[held], x[held], minlength=len(texts))  # noqa: B023, E731
                rid = part.column("rid").to_numpy()
                doc_id = np.array(part.column("doc_id").to_pylist(), object)
                rare = np.flatnonzero(~held)
                whole = len(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([rid, rid[owner[rare]]])),
                        pa.array(np.concatenate([doc_id, doc_id[owner[rare]]]), pa.int64()),
                        # A text's own row goes by a key of its own, to spread them.
                        pa.array(np.concatenate([rid, hashed[rare].view(np.int64)])),
                        pa.array(np.arange(whole + len(rare)) < whole),
                        pa.array(np.concatenate([lengths, np.zeros(len(rare), np.int64)])),
                        pa.array(np.concatenate([by_text(np.ones(len(held))), np.zeros(len(rare))]).astype(np.int64)),
                        pa.array(np.concatenate([by_text(base), np.zeros(len(rare))])),
                        pa.array(np.concatenate([by_text(score), lm[rare]])),
                    ],
                    names=[x.split()[0] for x in SCORED.split(", ")],
                )

    return rows


def score_texts(docs: DataFrame, learn: DataFrame, ranks: str = RANKS, steps: int = STEPS) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    ``learn`` are the rows to learn from, all of them for the counts and for the attention.
    """
    spark = docs.sparkSession
    counts = word_counts(learn)
    total, types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    keys, known_counts = frequent(counts)
    read = read_ranks(ranks)
    model, known = fit(learn, read, steps)
    shared = spark.sparkContext.broadcast((model, known, read, keys, known_counts, total, types))
    numbered = docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), "text"
    )
    rows = numbered.mapInArrow(_score_rows(shared), SCORED)
    joined = rows.join(counts, "key", "left")
    n = F.coalesce("n", F.lit(0)).cast("double")
    floor = float(np.log10(total + 0.5 * (types + 1)))
    base = F.log10(n + 0.5) - floor
    share = (n + 0.5) / F.lit(total + 0.5 * (types + 1))
    mixed = F.log10(F.lit(MODEL_SHARE) * F.exp("lm") + F.lit(1 - MODEL_SHARE) * share)
    text = F.col("is_text")
    return (
        joined.select(
            "rid",
            "doc_id",
            "n_tokens",
            F.when(text, F.col("n_known")).otherwise((n > 0).cast("long")).alias("n_known"),
            F.when(text, F.col("base")).otherwise(base).alias("base"),
            F.when(text, F.col("lm")).otherwise(mixed).alias("score"),
        )
        .groupBy("rid", "doc_id")
        .agg(
            F.sum("n_tokens").alias("n_tokens"),
            F.sum("n_known").alias("n_known"),
            F.sum("base").alias("base_score"),
            F.sum("score").alias("score"),
        )
        .select("doc_id", "n_tokens", "n_known", F.lit(int(total)).cast("long").alias("train_tokens"), "base_score", "score")
    )


def lm_report(docs: DataFrame, ranks: str = RANKS) -> DataFrame:
    """What the query returns."""
    held_out = id_crc(F.col("doc_id")) % 5 == 1
    scored = score_texts(docs, docs.filter(~held_out), ranks)
    return scored.withColumn("held_out", held_out).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
