"""What several operators share."""

import ctypes
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orgtrail.session import scratch_dir

#: Words: what stands between blanks, tabs and line ends.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_crc(doc_id: Column) -> Column:
    """CRC-32 of an id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def n_words(text: Column) -> Column:
    """Words in a text, 0 for null."""
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def at_rest(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """The rows, written once to the shared folder or to ``path``: cuts lineage, survives lost executors."""
    path = path or scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Hand memory that is free again back to the system, from Arrow's pool and, where it can be asked, the C library's.

    Both keep it otherwise, and in pieces that the next collected rows do not fit in, so that a driver
    that fits one model after another grows.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
