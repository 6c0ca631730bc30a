"""Join sides at rest: written once, measured while they are written, then read.

Spark plans a join by file sizes, not by what a filter leaves. A side that may be small is
therefore written to the shared folder first. The run that writes it counts its rows and bytes, so
that nothing is computed twice, and the join that reads it broadcasts it below a bound. Beyond the
bound the other table is cut beside its scan by a bitmap of the side's keys, and an exact join
behind it decides.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StringType, StructType

from orgtrail.session import scratch_dir

MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 128 * 1024 * 1024
#: Bits of a bitmap for each key; one in so many other keys passes by chance.
BITS_PER_KEY = 32
WORD_BITS, CHUNK_WORDS = 64, 512
CHUNK_BITS = WORD_BITS * CHUNK_WORDS
#: The largest bitmap that is broadcast. More keys share its bits, and more others pass.
MAX_BITMAP_BYTES = 64 * 1024 * 1024


def width(value: Column, kind: DataType) -> Column:
    """Bytes of text and nested values; 8 for any other value."""
    if isinstance(kind, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)).cast("long")
    if isinstance(kind, ArrayType):
        add = lambda size, item: size + width(item, kind.elementType)
        return F.coalesce(F.aggregate(value, F.lit(0).cast("long"), add), F.lit(0).cast("long"))
    if isinstance(kind, MapType):
        return width(F.map_keys(value), ArrayType(kind.keyType)) + width(F.map_values(value), ArrayType(kind.valueType))
    if isinstance(kind, StructType):
        return sum((width(value[field.name], field.dataType) for field in kind), F.lit(0).cast("long"))
    return F.lit(8).cast("long")


@dataclass(frozen=True)
class Side:
    """Rows at rest, and how many rows and bytes were written."""

    frame: DataFrame
    rows: int
    size: int

    def fits(self, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
        return self.rows <= max_rows and self.size <= max_bytes

    def hinted(self) -> DataFrame:
        """The rows, to be broadcast if they fit."""
        return F.broadcast(self.frame) if self.fits() else self.frame

    def select(self, *names: str) -> Side:
        """Some columns of the side, measured as the whole."""
        return Side(self.frame.select(*names), self.rows, self.size)


def rest(df: DataFrame, name: str) -> Side:
    """``df``, written to the shared folder and measured by the run that writes it."""
    seen = Observation()
    size = sum((width(F.col(f"`{f.name}`"), f.dataType) for f in df.schema), F.lit(0).cast("long"))
    path = scratch_dir(df.sparkSession, name)
    measured = df.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(size), F.lit(0)).alias("size")
    )
    measured.write.parquet(path)
    found = seen.get
    return Side(df.sparkSession.read.schema(df.schema).parquet(path), found.get("rows") or 0, found.get("size") or 0)


def as_side(df: DataFrame | Side, name: str) -> Side:
    return df if isinstance(df, Side) else rest(df, name)


def _slots(key: Column, chunks: int) -> dict[str, Column]:
    slot = F.pmod(F.xxhash64(key), F.lit(chunks * CHUNK_BITS))
    return {
        "_chunk": F.floor(slot / CHUNK_BITS).cast("int"),
        "_word": F.floor((slot % CHUNK_BITS) / WORD_BITS).cast("int"),
        "_bit": (slot % WORD_BITS).cast("int"),
    }


def _chunks(n_keys: int) -> int:
    most = MAX_BITMAP_BYTES * 8 // CHUNK_BITS
    return max(1, min(most, math.ceil(n_keys * BITS_PER_KEY / CHUNK_BITS)))


def key_bitmap(keys: Side, key: str) -> DataFrame:
    """The keys' bits: (_chunk, _bits) with 512 words a chunk, at most ``MAX_BITMAP_BYTES`` in all.

    Built by aggregates that merge in each task before the shuffle, whatever the keys' number; bits and
    zeros go through one and the same.
    """
    chunks = _chunks(keys.rows)
    slots = keys.frame.select(F.col(key).alias("_key")).filter("_key is not null").withColumns(_slots(F.col("_key"), chunks))
    words = slots.select("_chunk", "_word", F.expr("shiftleft(1L, _bit)").alias("_bits"))
    zeros = keys.frame.sparkSession.range(chunks * CHUNK_WORDS).select(
        F.floor(F.col("id") / CHUNK_WORDS).cast("int").alias("_chunk"),
        (F.col("id") % CHUNK_WORDS).cast("int").alias("_word"),
        F.lit(0).cast("long").alias("_bits"),
    )
    dense = words.unionByName(zeros).groupBy("_chunk", "_word").agg(F.bit_or("_bits").alias("_bits"))
    return dense.groupBy("_chunk").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("_word", "_bits"))), lambda w: w["_bits"]).alias("_bits")
    )


def maybe_listed(df: DataFrame, keys: Side, key: str) -> DataFrame:
    """``df`` without most rows of other keys, cut where it is read; no listed row is lost.

    The bitmap is a broadcast of bounded size, so the cut shuffles nothing. It does not replace
    the exact join that follows. It is a semi join itself: the optimiser would move an exact semi
    join below any other one, and shuffle what was to be cut.
    """
    slots = _slots(df[key], _chunks(keys.rows))
    bits = key_bitmap(keys, key)
    word = F.get(bits["_bits"], slots["_word"])
    # The bit is moved to the lowest place; a shift by a column has no function of its own.
    set_ = F.call_function("shiftrightunsigned", word, slots["_bit"]).bitwiseAND(F.lit(1).cast("long")) == 1
    return df.join(F.broadcast(bits), (bits["_chunk"] == slots["_chunk"]) & set_, "left_semi")


def cut_to(df: DataFrame, keys: Side, key: str) -> DataFrame:
    """``df`` without rows of other keys before an outer join on ``key``.

    It changes what the join has to shuffle, not what the join returns.
    """
    if keys.fits():
        return df.join(F.broadcast(keys.frame.select(key)), key, "left_semi")
    return maybe_listed(df, keys, key)
