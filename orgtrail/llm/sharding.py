"""Sharding by jump consistent hashing: a key finds its shard without a table of shards.

Native: one pass of column expressions for the shard, two small counts for the slots.

Edge cases: a null key counts as key -1; a null text has no bytes and the CRC-32 of no bytes
(0); rows that repeat a key share its shard and get slots of their own; rows that are equal
in every respect may swap slots between runs, nothing else may; an empty table gives no rows.
Texts of any length are read whole. A key, a null one too, may hold any share of the rows: its
rows are numbered in parts by their texts, so only equal texts under one key share a part.
Columns of the input that clash with an output name are replaced.
"""

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The step of the published generator (Lamping and Veach, 2014): fixed values.
JUMP_FACTOR = 2862933555777941757
JUMP_SPAN = 1 << 31
JUMP_SHIFT = 1 << 33
WORD_SPAN = Decimal(1 << 64)

#: Parts of a shard that are numbered side by side.
SLOT_PARTS = 256


def jump_shard(key: Column, n_shards: int) -> Column:
    """The shard of a 64-bit key, 0 to ``n_shards - 1``.

    The key seeds a linear congruential generator, each draw of which tells the next shard
    count at which the key moves; the last such count below ``n_shards`` is its shard. A key
    therefore only ever moves into shards that are added. Products of two 64-bit numbers are
    taken as decimals and cut back, since a long would overflow.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be 1 or more")
    wide = "decimal(20,0)"
    signed = F.coalesce(key.cast("long"), F.lit(-1).cast("long")).cast(wide)
    seed = F.when(signed < 0, signed + F.lit(WORD_SPAN).cast(wide)).otherwise(signed).cast(wide)
    start = F.struct(
        F.lit(-1).cast("long").alias("at"), F.lit(0).cast("long").alias("next"), seed.alias("state")
    )

    def draw(state: Column) -> Column:
        product = state * F.lit(JUMP_FACTOR).cast("decimal(19,0)") + F.lit(1).cast("decimal(1,0)")
        return (product % F.lit(WORD_SPAN).cast(wide)).cast(wide)

    def step(now: Column, _: Column) -> Column:
        drawn = F.transform(
            F.array(draw(now["state"])),
            lambda state: F.struct(
                now["next"].alias("at"),
                F.floor(
                    (now["next"] + F.lit(1)).cast("double")
                    * (
                        F.lit(float(JUMP_SPAN))
                        / (F.floor(state / F.lit(JUMP_SHIFT).cast(wide)).cast("double") + F.lit(1.0))
                    )
                )
                .cast("long")
                .alias("next"),
                state.alias("state"),
            ),
        )
        return F.when(now["next"] >= F.lit(n_shards), now).otherwise(F.get(drawn, F.lit(0)))

    steps = F.sequence(F.lit(1), F.lit(n_shards))
    return F.aggregate(steps, start, step, lambda end: end["at"]).cast("int")


def assign_shards(
    df: DataFrame, key: str = "doc_id", text: str = "text", n_shards: int = 24, parts: int = SLOT_PARTS
) -> DataFrame:
    """The rows with ``size``, ``text_crc32``, ``law``, ``shard``, ``slot`` and ``grown_shard``.

    Slots number the rows of a shard without gaps. A shard is cut into ``parts`` by a hash of
    the key and the text's CRC and size; each part is numbered by itself and starts where the parts before it end. Only
    the counts of parts (``n_shards * parts`` rows) are broadcast.
    """
    bytes_ = F.encode(F.coalesce(F.col(text).cast("string"), F.lit("")), "UTF-8")
    placed = df.withColumns(
        {
            "shard": jump_shard(F.col(key), n_shards),
            "size": (F.octet_length(bytes_) + F.lit(8)).cast("long"),
            "text_crc32": F.crc32(bytes_).cast("long"),
        }
    )
    placed = placed.withColumn("_part", F.pmod(F.xxhash64(F.col(key), "text_crc32", "size"), F.lit(parts)).cast("int"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("shard", "_part").agg(F.count(F.lit(1)).alias("_rows"))
    starts = counts.select("shard", "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    measured = placed.withColumns(
        {
            "law": F.lit("key"),
            "grown_shard": jump_shard(F.col(key), n_shards + 1),
        }
    )
    inside = Window.partitionBy("shard", "_part").orderBy(key, "text_crc32", "size")
    return (
        measured.withColumn("_row", F.row_number().over(inside))
        .join(F.broadcast(starts), ["shard", "_part"])
        .withColumn("slot", (F.col("_start") + F.col("_row") - 1).cast("long"))
        .drop("_part", "_row", "_start")
    )


def write_shards(df: DataFrame, path: str, n_shards: int = 24, key: str = "doc_id", text: str = "text") -> None:
    """Parquet folders ``shard=0`` and on; a shard is written by many tasks, each in slot order."""
    placed = assign_shards(df, key, text, n_shards)
    (
        placed.repartition("shard", F.floor(F.col("slot") / F.lit(1 << 16)))
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )


def shard_report(docs: DataFrame, n_shards: int = 24) -> DataFrame:
    """What the query returns; only the columns it needs are shuffled, not the texts."""
    columns = ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    return assign_shards(docs.select("doc_id", "text"), n_shards=n_shards).select(*columns)
