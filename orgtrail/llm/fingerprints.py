"""Document fingerprints from closed syncmers, matched by position.

A k-mer of tokens is an anchor when the smallest of its inner s-mers, by hash, is its first or
its last one. Whether a k-mer is chosen depends on the k-mer alone, so an edit only disturbs
the anchors that overlap it, and two texts choose the same anchors in a passage they share; of
``k - s`` neighbouring k-mers at least one is chosen. Tokens are runs between blanks; in scripts
without blanks each character is one. The fingerprint lists all distinct anchors of the text in
order of their hash, each with the position (token number) of its first occurrence.

Two fingerprints are matched by hash and offset. An anchor that both have counts as alike when
its offset lies in the band of a global alignment: between none and the difference of the
lengths, and ``SLACK`` of the longer text to either side. So texts with the same parts in
another order aren't alike. The longest run of one offset without a gap is the passage that
both share, wherever it stands.

Native: array functions over tokens; no rows are exploded. Texts are shuffled once, into ranges
of ids that are put in order side by side; there each text meets the next one's.

Edge cases: a text with fewer tokens than ``k`` is one anchor; a text without tokens (the empty
or null one) has none and an empty fingerprint; two empty fingerprints are alike (1), an empty
and another are not (0); of equal k-mers in a text the first counts, of equally long passages
the one with the smallest offset, then the first. Very long texts have as many anchors more. Of
rows that repeat a doc_id, the one with the smallest SHA-256 stands for the document when
another asks for its next; an id with many rows is dealt to several tasks. Null ids come last and
are followed by the first document; an only document follows itself; an empty table gives no
rows. Columns that clash with an output name are not read.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orgtrail.llm.common import let, text_or_empty

K = 5
S = 2
#: Offset beside the band, as a share of the longer text.
SLACK = 1 / 16
#: Ranges of ids that are put in order side by side.
RANGES = 512
#: Blocks of scripts written without blanks: Thai and Lao, Myanmar, Khmer, kana, Han.
_SINGLE = r"\x{E00}-\x{EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}"
#: The characters outside of them that aren't blanks, those of most texts first.
_OTHER = (
    r"\x21-\x{DFF}\x00-\x08\x0E-\x1F\x{F00}-\x{FFF}\x{10A0}-\x{177F}\x{1800}-\x{303F}\x{3100}-\x{33FF}\x{A000}-\x{F8FF}"
    r"\x{FB00}-\x{1FFFF}\x{40000}-\x{10FFFF}"
)
TOKEN = rf"[{_OTHER}]++|[{_SINGLE}]"
#: Bits of a hash that are kept.
HASH_BITS = 48
ANCHORS = "array<struct<hash:bigint,at:int>>"


def _hash(*values: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*values), 64 - HASH_BITS)


def tokens(text: Column) -> Column:
    """Hashes of a text's tokens, in order."""
    return F.transform(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), lambda x: F.xxhash64(x))


def anchors(words: Column, k: int = K, s: int = S) -> Column:
    """array<struct<hash, at>> of the closed syncmers of token hashes, in order of position."""
    span = k - s
    if s < 1 or span < 2:
        raise ValueError("k must exceed s by 2 or more")

    def mer(words: Column, at: Column, n: int) -> Column:
        return _hash(*[F.get(words, at + j) for j in range(n)])

    def chosen(words: Column, inner: Column) -> Column:
        lowest = lambda i, steps: F.array_min(F.array(*[F.get(inner, i + j) for j in steps]))
        at_edge = F.filter(
            F.sequence(F.lit(0), F.size(words) - F.lit(k)),
            lambda i: lowest(i, (0, span)) <= lowest(i, range(1, span)),
        )
        return F.transform(at_edge, lambda i: F.struct(mer(words, i, k).alias("hash"), i.alias("at")))

    def of_words(words: Column) -> Column:
        n = F.size(words)
        inner = F.transform(F.sequence(F.lit(0), n - F.lit(s)), lambda i: mer(words, i, s))
        whole = F.array(F.struct(_hash(words).alias("hash"), F.lit(0).alias("at")))
        return (
            F.when(n == 0, F.array().cast(ANCHORS))
            .when(n < k, whole)
            .otherwise(let(inner, lambda hashes: chosen(words, hashes)))
        )

    return let(words, of_words)


def distinct_anchors(found: Column) -> Column:
    """The anchors in order of their hash, the first of equal ones."""

    def firsts(ordered: Column) -> Column:
        return F.filter(ordered, lambda x, i: (i == 0) | (F.get(ordered, i - 1)["hash"] != x["hash"]))

    return let(F.sort_array(found), firsts)


def fingerprint_text(found: Column) -> Column:
    """Per anchor 12 digits of hash and 8 of position."""
    digits = lambda x: F.concat(
        F.lpad(F.hex(x["hash"]), HASH_BITS // 4, "0"), F.lpad(F.hex(x["at"].cast("long")), 8, "0")
    )
    return F.array_join(F.transform(found, digits), "")


def shared_anchors(left: Column, right: Column) -> Column:
    """array<struct<shift, at>>: anchors of both, with the offset to the right one.

    Both are distinct and in order of hash, so equal hashes meet as neighbours in the merged order.
    """

    def tagged(found: Column, side: int) -> Column:
        return F.transform(found, lambda x: F.struct(x["hash"].alias("hash"), F.lit(side).alias("side"), x["at"].alias("at")))

    def meet(both: Column) -> Column:
        rest = F.greatest(F.size(both) - 1, F.lit(0))
        pairs = F.zip_with(
            F.slice(both, F.lit(1), rest),
            F.slice(both, F.lit(2), rest),
            lambda x, y: F.when(
                x["hash"] == y["hash"], F.struct((y["at"] - x["at"]).alias("shift"), x["at"].alias("at"))
            ),
        )
        return F.filter(pairs, lambda p: p.isNotNull())

    return let(F.sort_array(F.concat(tagged(left, 0), tagged(right, 1))), meet)


def likeness(left: Column, right: Column, shared: Column, n_left: Column, n_right: Column) -> Column:
    """Of the anchors of either text, the share that both have in place."""
    more = n_right - n_left
    slack = F.floor(F.greatest(n_left, n_right) * F.lit(SLACK))
    low, high = F.least(F.lit(0), more) - slack, F.greatest(F.lit(0), more) + slack
    in_place = F.size(F.filter(shared, lambda p: (p["shift"] >= low) & (p["shift"] <= high)))
    union = F.size(left) + F.size(right) - F.size(shared)
    return F.when(union == 0, F.lit(1.0)).otherwise(in_place / union)


def passage(shared: Column, k: int = K) -> Column:
    """struct<at, shift, n>: the longest run of one offset without a gap, in tokens."""
    start = F.struct(*[F.lit(0).alias(x) for x in ("at", "shift", "n", "from", "offset", "end")])

    def step(run: Column, p: Column) -> Column:
        goes_on = (run["end"] > 0) & (p["shift"] == run["offset"]) & (p["at"] <= run["end"])
        begun = F.when(goes_on, run["from"]).otherwise(p["at"])
        longer = p["at"] + k - begun > run["n"]
        return F.struct(
            F.when(longer, begun).otherwise(run["at"]).alias("at"),
            F.when(longer, p["shift"]).otherwise(run["shift"]).alias("shift"),
            F.when(longer, p["at"] + k - begun).otherwise(run["n"]).alias("n"),
            begun.alias("from"),
            p["shift"].alias("offset"),
            (p["at"] + k).alias("end"),
        )

    return F.aggregate(F.sort_array(shared), start, step)


def id_ranges(docs: DataFrame, ranges: int = RANGES) -> tuple[list[int], list[int], int]:
    """Edges of the ranges, tasks of each range and of the null ids; numbers are all that is collected.

    Range ``i`` holds the ids from edge ``i - 1`` on and below edge ``i``. An id that holds more
    rows than a range should is a range of its own, with as many tasks as it fills.
    """
    shares = [i / ranges for i in range(1, ranges)]
    found = docs.agg(
        F.percentile_approx(F.col("doc_id").cast("long"), shares, 10 * ranges).alias("cuts"),
        F.count("doc_id").alias("known"),
        F.count(F.lit(1)).alias("all"),
    ).first()
    cuts = list(found["cuts"] or [])
    edges = sorted({*cuts, *(c + 1 for c in cuts if cuts.count(c) > 1 and c < (1 << 63) - 1)})
    tasks = [1] + [max(cuts.count(edge), 1) for edge in edges]
    return edges, tasks, max(1, ranges * (found["all"] - found["known"]) // max(found["all"], 1))


def beside_next(docs: DataFrame, ranges: int = RANGES) -> DataFrame:
    """The documents in tasks by range (``_range``, ``_task``), with a copy of what follows each range.

    ``_guest`` marks the copies, which are one row of each following document for each task.
    """
    spark = docs.sparkSession
    edges, tasks, null_tasks = id_ranges(docs, ranges)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(F.col("text")).alias("text"))
    held = F.size(F.filter(F.lit(edges) if edges else F.array().cast("array<bigint>"), lambda e: e <= F.col("doc_id")))
    of_range = F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(held)
    firsts = dict(base.groupBy(of_range.alias("r")).agg(F.min("doc_id")).collect())
    used = sorted(r for r in firsts if r >= 0)
    follow = {r: firsts[after] for r, after in zip(used, [*used[1:], *used[:1]], strict=True)}
    if -1 in firsts:
        follow[-1] = firsts[used[0]] if used else None
    n_tasks = lambda r: null_tasks if r < 0 else tasks[r]
    asks = [(r, t, follow[r]) for r in follow for t in range(n_tasks(r))]
    all_tasks = F.lit([null_tasks, *tasks])
    own = base.select(
        "doc_id",
        "text",
        of_range.alias("_range"),
        F.lit(False).alias("_guest"),
    ).withColumn("_task", F.pmod(F.xxhash64("text"), F.get(all_tasks, F.col("_range") + 1)).cast("int"))
    if not asks:
        return own
    wanted = F.col("doc_id").isin([x for x in {f for _, _, f in asks} if x is not None])
    if not used:
        wanted = F.col("doc_id").isNull()
    heads = base.filter(wanted).groupBy("doc_id").agg(F.min_by("text", F.sha2("text", 256)).alias("text"))
    pick = lambda values: F.get(F.lit(values), F.col("id").cast("int"))
    places = spark.range(len(asks)).select(
        pick([r for r, _, _ in asks]).alias("_range"),
        pick([t for _, t, _ in asks]).alias("_task"),
        (pick([f for _, _, f in asks]) if used else F.lit(None)).cast("long").alias("_id"),
    )
    guests = heads.join(F.broadcast(places), F.col("doc_id").eqNullSafe(F.col("_id"))).drop("_id")
    return own.unionByName(guests.withColumn("_guest", F.lit(True)))


def fingerprint_edits(docs: DataFrame, k: int = K, s: int = S, ranges: int = RANGES) -> DataFrame:
    """Fingerprints of all texts and of their edited texts, and how alike they and the next are.

    ``passage_at``, ``passage_next_at`` and ``passage_tokens`` say where the longest passage
    stands that the text shares with the next one, in tokens.
    """
    prints = lambda words: distinct_anchors(anchors(F.col(words), k, s))
    place = ["_range", "_task", "_guest"]
    dealt = (
        beside_next(docs, ranges)
        .repartition("_range", "_task")
        .withColumn("_sha", F.sha2("text", 256))
        .withColumn("_words", tokens(F.col("text")))
        .select(*place, "doc_id", "text", "_sha", F.size("_words").alias("_n"), prints("_words").alias("_own"))
    )
    in_order = Window.partitionBy("_range", "_task").orderBy("_guest", "doc_id", "_sha")
    after = F.lead(F.struct("_guest", "doc_id", "text", "_n", "_own")).over(in_order)
    other = (F.col("_after._guest") != F.col("_guest")) | ~F.col("_after.doc_id").eqNullSafe(F.col("doc_id"))
    # The last row of an id sees the next document; all rows of the id take it from there.
    met = (
        dealt.withColumn("_after", after)
        .withColumn("_after", F.when(other, F.col("_after")))
        .withColumn("_next", F.first("_after", True).over(Window.partitionBy(*place, "doc_id")))
        .filter(~F.col("_guest"))
    )
    n_chars = F.char_length("text")
    fresh = F.floor(n_chars / 4).cast("int")
    edited = F.concat(F.left("text", n_chars - fresh), F.left(F.col("_next.text"), fresh))
    matched = (
        met.select("doc_id", n_chars.cast("long").alias("n_chars"), "_n", "_own", "_next", edited.alias("_text"))
        .withColumn("_words", tokens(F.col("_text")))
        .withColumn("_edited", prints("_words"))
        .withColumn("_kept", shared_anchors(F.col("_own"), F.col("_edited")))
        .withColumn("_both", shared_anchors(F.col("_own"), F.col("_next._own")))
        .withColumn("_passage", passage(F.col("_both"), k))
    )
    return matched.select(
        "doc_id",
        "n_chars",
        F.sha2("_text", 256).alias("edited_sha256"),
        fingerprint_text(F.col("_own")).alias("fingerprint"),
        fingerprint_text(F.col("_edited")).alias("edited_fingerprint"),
        likeness(F.col("_own"), F.col("_edited"), F.col("_kept"), F.col("_n"), F.size("_words")).alias("near_edited"),
        likeness(F.col("_own"), F.col("_next._own"), F.col("_both"), F.col("_n"), F.col("_next._n")).alias("near_next"),
        F.col("_passage.at").cast("long").alias("passage_at"),
        (F.col("_passage.at") + F.col("_passage.shift")).cast("long").alias("passage_next_at"),
        F.least(F.col("_passage.n"), F.col("_n")).cast("long").alias("passage_tokens"),
    )
