"""Mixing sources to target weights with a low-discrepancy schedule.

Every source is a stream of its documents in a shuffled order, cut into blocks of equally many
words. Slot ``j`` of the schedule takes the point ``frac((j + 1) * golden ratio)``, and the
source in whose part of [0, 1) the point falls. The ``r``-th slot of a source takes its block
``r`` modulo its number of blocks, so a source is read evenly and comes round again only after
all of it was read. The last slot takes a part of its block, so that the target is met to a word.

Edge cases: a null text has no words; null is a source of its own, last in order; documents
without words belong to no block and are taken 0 times; rows that repeat a doc_id are rows of
their own; equal hashes of ids go by id, then size; texts of any length are counted whole; an
empty table gives no rows; columns that clash with an output name are replaced.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orgtrail.llm.common import at_rest, n_words

#: (sqrt(5) - 1) / 2.
GOLDEN = 0.6180339887498949
#: Slots that one pass over all words makes, at any size of the input. Targets are met to a word
#: whatever the length of a block: each source's slots are settled, see ``schedule``.
SLOTS = 1 << 18
#: A source, and so a document, is taken so many times at most.
REPEATS = 3
#: Weights of the sources by code point, repeating.
WEIGHTS = (1, 2, 3)
#: Pieces in which [0, 1), a source's shuffled order and its slots are worked on side by side.
CELLS = 4096


def shuffle_key(doc_id: Column) -> Column:
    return F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def source_targets(sized: DataFrame) -> DataFrame:
    """Per source its size, target and number of blocks, from rows with ``source`` and ``size``.

    Works on one row per source. A source is full when its limit divided by its weight is
    below the level that the others share; the level follows from running sums in that order.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    weighed = sums.withColumns(
        {
            "_weight": F.get(weights, F.pmod(F.row_number().over(by_name) - 1, F.lit(len(WEIGHTS)))),
            "_limit": F.col("source_size") * REPEATS,
            "_all": F.sum("source_size").over(Window.partitionBy()),
        }
    )
    ratio = F.col("_limit") / F.col("_weight")
    earlier = Window.orderBy(ratio, F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("_all") - F.coalesce(F.sum("_limit").over(earlier), F.lit(0))) / (
        F.sum("_weight").over(Window.partitionBy()) - F.coalesce(F.sum("_weight").over(earlier), F.lit(0))
    )
    levels = weighed.withColumn("_own", level).withColumn(
        "_level", F.max(F.when(ratio > F.col("_own"), F.col("_own"))).over(Window.partitionBy())
    )
    target = F.when(ratio <= F.col("_own"), F.col("_limit").cast("double")).otherwise(
        F.coalesce(F.col("_level"), F.col("_own")) * F.col("_weight")
    )
    block = F.greatest(F.ceil(F.col("_all") / F.lit(SLOTS)), F.lit(1))
    return levels.select(
        "source",
        "source_size",
        target.alias("target"),
        F.ceil(F.col("source_size") / block).cast("long").alias("blocks"),
    )


def schedule(targets: DataFrame) -> DataFrame:
    """The slots in order: ``slot``, ``source``, ``rank`` in the source and the ``block`` it takes.

    A source's part of [0, 1) is in proportion to ``target * blocks / size``. Points find their
    source by an equality join on the cell of [0, 1) they lie in, sources being listed in each
    cell they touch. Points come near these numbers only, so they are settled: slots beyond
    those that the target needs are left out, missing ones follow at the end, and of the last
    one only ``words`` are taken (null: the whole block).
    """
    wanted = targets.filter("source_size > 0").withColumn(
        "_wanted", F.col("target") * F.col("blocks") / F.col("source_size")
    )
    order = Window.orderBy(F.col("source").asc_nulls_last())
    total = F.sum("_wanted").over(Window.partitionBy())
    upto = F.sum("_wanted").over(order.rowsBetween(Window.unboundedPreceding, 0))
    before = F.sum("_wanted").over(order.rowsBetween(Window.unboundedPreceding, -1))
    last = F.row_number().over(order) == F.count(F.lit(1)).over(Window.partitionBy())
    parts = wanted.select(
        "source",
        "blocks",
        F.round(total).cast("long").alias("_slots"),
        F.coalesce(before / total, F.lit(0.0)).alias("_low"),
        F.when(last, F.lit(1.0)).otherwise(upto / total).alias("_high"),
    )
    cells = parts.withColumn(
        "_cell",
        F.explode(
            F.sequence(
                F.least(F.floor(F.col("_low") * CELLS), F.lit(CELLS - 1)),
                F.least(F.floor(F.col("_high") * CELLS), F.lit(CELLS - 1)),
            )
        ),
    )
    slots = (
        parts.agg(F.max("_slots").alias("_n"))
        .filter("_n > 0")
        .select(F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / CELLS))).alias("_chunk"), "_n")
        .repartition("_chunk")
        .select(
            "_chunk",
            F.explode(
                F.sequence(
                    F.col("_chunk") * CELLS, F.least(F.col("_chunk") * CELLS + (CELLS - 1), F.col("_n") - 1)
                )
            ).alias("slot"),
        )
        .withColumn("_at", (F.col("slot") + 1) * F.lit(GOLDEN))
        .withColumn("_at", F.col("_at") - F.floor("_at"))
        .withColumn("_cell", F.floor(F.col("_at") * CELLS))
    )
    held = at_rest(slots.join(cells, "_cell").filter("_at >= _low and _at < _high").select("_chunk", "slot", "source"), "slots")
    inside = held.withColumn(
        "_row", F.row_number().over(Window.partitionBy("source", "_chunk").orderBy("slot"))
    )
    counts = inside.groupBy("source", "_chunk").agg(F.count(F.lit(1)).alias("_rows"))
    sofar = Window.partitionBy("source").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("source").alias("_source"),
        F.col("_chunk").alias("_of"),
        F.coalesce(F.sum("_rows").over(sofar), F.lit(0)).alias("_start"),
    )
    ranked = inside.join(starts, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_chunk") == F.col("_of"))).select(
        "slot", "source", (F.col("_start") + F.col("_row") - 1).cast("long").alias("rank")
    )
    # All words to take, the slots that hold them, and the words of the last one; exact in longs.
    due = (
        wanted.withColumn("_slots", F.round(total).cast("long"))
        .withColumn("_due", F.round("target").cast("long"))
        .filter("_due > 0")
        .withColumn("_last_word", F.expr("(_due - 1) % source_size"))
        .withColumn("_last_block", F.expr("_last_word * blocks div source_size"))
        .withColumn("_need", F.expr("(_due - 1) div source_size * blocks + _last_block + 1"))
        .withColumn("_words", F.expr("_last_word + 1 - (_last_block * source_size + blocks - 1) div blocks"))
        .select(F.col("source").alias("_source"), "blocks", "_slots", "_need", "_words")
    )
    had = counts.groupBy(F.col("source").alias("_had")).agg(F.sum("_rows").alias("_held"))
    short = (
        due.join(had, F.col("_source").eqNullSafe(F.col("_had")), "left")
        .withColumn("_held", F.coalesce("_held", F.lit(0)).cast("long"))
        .filter("_held < _need")
    )
    earlier = Window.orderBy(F.col("_source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    late = (
        short.withColumn("_late", F.coalesce(F.sum(F.col("_need") - F.col("_held")).over(earlier), F.lit(0)))
        .withColumn("rank", F.explode(F.sequence("_held", F.col("_need") - 1)))
        .select((F.col("_slots") + F.col("_late") + F.col("rank") - F.col("_held")).alias("slot"), F.col("_source").alias("source"), "rank")
    )
    return (
        ranked.unionByName(late)
        .join(due, F.col("source").eqNullSafe(F.col("_source")))
        .filter("rank < _need")
        .select(
            "slot",
            "source",
            "rank",
            F.pmod("rank", "blocks").alias("block"),
            F.when(F.col("rank") == F.col("_need") - 1, F.col("_words")).alias("words"),
        )
    )


def in_stream(sized: DataFrame) -> DataFrame:
    """The rows with ``_from``: words of the same source that stand before them when shuffled.

    The shuffled order is that of the MD5 of doc_id. It is cut by the first three digits, so
    that a source of any size is summed in 4,096 parts.
    """
    keyed = sized.withColumn("_md5", shuffle_key(F.col("doc_id"))).withColumn("_digits", F.substring("_md5", 1, 3))
    sums = keyed.groupBy("source", "_digits").agg(F.sum("size").alias("_words"))
    sofar = Window.partitionBy("source").orderBy("_digits").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        F.col("source").alias("_source"),
        F.col("_digits").alias("_of"),
        F.coalesce(F.sum("_words").over(sofar), F.lit(0)).alias("_start"),
    )
    keys = [name for name in ("text_key",) if name in sized.columns]
    inside = (
        Window.partitionBy("source", "_digits")
        .orderBy("_md5", "doc_id", "size", *keys)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        keyed.withColumn("_inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(starts, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_digits") == F.col("_of")))
        .withColumn("_from", (F.col("_start") + F.col("_inner")).cast("long"))
        .drop("_md5", "_digits", "_source", "_of", "_start", "_inner")
    )


def mix(docs: DataFrame) -> DataFrame:
    """Per row ``doc_id``, ``source``, ``size``, ``source_size``, ``target`` and ``taken`` words.

    Block ``b`` of a source of ``s`` words in ``n`` blocks holds its words from ``b * s / n``
    on. A document is cut into the pieces that lie in one block each; a piece counts as often
    as the schedule takes its block, and what of it lies in the part that a last slot takes once more.
    """
    return _taken(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")))


def _taken(sized: DataFrame) -> DataFrame:
    """As ``mix``, from rows with ``size``; ``text_key``, if there, tells rows apart and stays."""
    keys = ["doc_id", "source", "size", *(["text_key"] if "text_key" in sized.columns else [])]
    whole = [*keys, "source_size", "target"]
    # Read from rest: the schedule asks for the targets many times, and each would plan them anew.
    targets = at_rest(source_targets(sized), "targets")
    visits = schedule(targets).groupBy("source", "block").agg(
        F.count(F.when(F.col("words").isNull(), 1)).alias("_visits"), F.coalesce(F.max("words"), F.lit(0)).alias("_part")
    )
    visits = at_rest(visits, "visits")
    named = targets.withColumnRenamed("source", "_named")
    placed = in_stream(sized).join(named, F.col("source").eqNullSafe(F.col("_named"))).drop("_named")
    # Rows that agree in all columns count once and are multiplied back at the end.
    placed = placed.groupBy(*whole, "blocks", "_from").agg(
        F.count(F.lit(1)).alias("_copies")
    )
    # Exact in longs: the block of word w is floor(w * n / s).
    block_of = lambda word: F.expr(f"({word}) * blocks div source_size")
    pieces = (
        placed.filter("size > 0")
        .withColumn("block", F.explode(F.sequence(block_of("_from"), block_of("_from + size - 1"))))
        .withColumn("_low", F.expr("(block * source_size + blocks - 1) div blocks"))
        .withColumn("_high", F.expr("((block + 1) * source_size + blocks - 1) div blocks"))
        .withColumn(
            "_words", F.least(F.col("_high"), F.col("_from") + F.col("size")) - F.greatest(F.col("_low"), F.col("_from"))
        )
    )
    seen = visits.select(F.col("source").alias("_named"), F.col("block").alias("_nth"), "_visits", "_part")
    taken = (
        pieces.join(seen, F.col("source").eqNullSafe(F.col("_named")) & (F.col("block") == F.col("_nth")), "left")
        .withColumn(
            "_partly",
            F.least(F.col("_low") + F.col("_part"), F.col("_from") + F.col("size")) - F.greatest("_low", "_from"),
        )
        .withColumn(
            "_taken",
            F.coalesce(F.col("_words") * F.col("_visits") + F.greatest(F.col("_partly"), F.lit(0)), F.lit(0)),
        )
        .select(*whole, "_copies", "_from", "_taken")
    )
    idle = placed.filter("size = 0").select(*whole, "_copies", "_from", F.lit(0).cast("long").alias("_taken"))
    return (
        taken.unionByName(idle)
        .groupBy(*whole, "_copies", "_from")
        .agg(F.sum("_taken").cast("long").alias("taken"))
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
        .select("doc_id", "source", "size", *keys[3:], "source_size", "target", "taken")
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents of the mix, each row repeated as often as its words are taken on average.

    Half a time counts as one; a row whose blocks are not taken, or that has no words, is not
    in the mix. Rows are told apart by id, source and text; of rows that agree in these, each
    has its own place in the stream, and the rows in the order of all their columns are
    repeated in the order of these places' times, the least first.
    """
    text_key = F.unhex(F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")))
    sized = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), text_key.alias("text_key"))
    times = F.round(F.col("taken") / F.col("size")).cast("int")
    found = (
        _taken(sized)
        .filter("size > 0")
        .groupBy(F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("text_key").alias("__key"))
        .agg(F.array_sort(F.collect_list(times)).alias("__times"))
        .filter("array_max(__times) > 0")
    )
    found = at_rest(found, "times")
    same = (
        F.col("doc_id").eqNullSafe(F.col("__id"))
        & F.col("source").eqNullSafe(F.col("__source"))
        & (text_key == F.col("__key"))
    )
    columns = [F.col(f"`{name}`") for name in docs.columns]
    alone = docs.join(found.filter("size(__times) = 1"), same).select(*columns, F.col("__times")[0].alias("__n"))
    # Equal rows are counted, not gathered: a group has one row per distinct content.
    several = (
        docs.join(found.filter("size(__times) > 1"), same)
        .groupBy("__id", "__source", "__key", "__times", F.struct(*columns).alias("__row"))
        .agg(F.count(F.lit(1)).alias("__rows"))
    )
    upto = Window.partitionBy("__id", "__source", "__key").orderBy("__row").rowsBetween(Window.unboundedPreceding, 0)
    own = several.withColumn("__end", F.sum("__rows").over(upto)).withColumn(
        "__n",
        F.aggregate(
            F.slice("__times", (F.col("__end") - F.col("__rows") + 1).cast("int"), F.col("__rows").cast("int")),
            F.lit(0),
            lambda n, x: n + x,
        ),
    )
    picked = own.select(*[F.col(f"__row.`{name}`").alias(name) for name in docs.columns], "__n")
    return (
        alone.unionByName(picked)
        .filter("__n > 0")
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__n"))))
        .select(*columns)
    )
