"""Distinct rows, latest rows per key and sorted arrays per key."""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orgtrail.operators.sides import rest

#: Rows that one task gathers where rows are dealt by their number.
TASK_ROWS = 250_000


def task_parts(rows: int) -> int:
    """Partitions of about ``TASK_ROWS`` rows."""
    return max(1, math.ceil(rows / TASK_ROWS))


def distinct(df: DataFrame) -> DataFrame:
    return df.distinct()


def one_per_person(df: DataFrame) -> DataFrame:
    """One row per person and shown address; needs no grouping once nothing was exploded."""
    return df.select("pid", "first_name", "last_name", "last_address").distinct()


def latest_per_key(df: DataFrame, key: str, order: list[str], k: int) -> DataFrame:
    """The ``k`` latest rows of each key.

    Each task cuts its own rows to ``k`` per key before the shuffle, so a hot key sends
    ``k`` rows per task.
    """
    latest_first = Window.partitionBy(key).orderBy(*[F.desc(name) for name in order])
    return (
        df.withColumn("latest_rank", F.row_number().over(latest_first))
        .filter(F.col("latest_rank") <= k)
        .drop("latest_rank")
    )


def _sorted_values(order: list[str], value: Column | list[str]) -> Column:
    if isinstance(value, list):  # columns, of which those in the order are gathered once
        row = F.struct(*order, *[name for name in value if name not in order])
        return F.transform(F.sort_array(F.collect_list(row)), lambda item: F.struct(*[item[name].alias(name) for name in value]))
    keyed = F.struct(*order, value.alias("value"))
    return F.transform(F.sort_array(F.collect_list(keyed)), lambda item: item["value"])


def collect_latest(
    df: DataFrame, key: str, order: list[str], k: int, value: Column, name: str
) -> DataFrame:
    """Per key the ``k`` latest values as an ascending array."""
    return (
        latest_per_key(df, key, order, k).groupBy(key).agg(_sorted_values(order, value).alias(name))
    )


def numbered(df: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """``df`` with each row's number in its key from 0, missing values first, whatever the key's size.

    Rows are cut into ranges of (key, order) by quantiles, so that a hot key takes as many ranges as
    its share of the rows asks for. The ranges are written at rest, for their bounds must not change
    between the two reads: rows are numbered inside their range, and the counts of a key's earlier
    ranges are added. Only the first key of a range can have earlier ones, so there are no
    more such counts than ranges, and they are broadcast.
    """
    ascending = [F.asc_nulls_first(column) for column in order]
    ranged = df.repartitionByRange(F.asc_nulls_first(key), *ascending).withColumn("_range", F.spark_partition_id())
    ranged = rest(ranged, "ranges").frame
    counts = ranged.groupBy(key, "_range").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(key, "_range", F.sum("_rows").over(earlier).alias("_start")).filter("_start is not null")
    inside = Window.partitionBy("_range", key).orderBy(*ascending)
    rows = ranged.withColumn(name, F.row_number().over(inside) - 1).join(F.broadcast(starts), [key, "_range"], "left")
    return rows.withColumn(name, F.col(name) + F.coalesce("_start", F.lit(0))).select(*df.columns, name)


def collect_sorted(
    df: DataFrame,
    key: str,
    order: list[str],
    value: Column | list[str],
    name: str,
    page_rows: int | None = None,
) -> DataFrame:
    """Per key the values as an array sorted by ``order``, missing first: key, page, array.

    Without ``page_rows`` every key has one array, on page 0. With it, an array holds so many
    values and a key goes on in pages 1, 2, ... in the full order, whatever its size: the rows
    of a hot key are numbered and gathered by many tasks, and no array is longer than a page.
    ``order`` must tell the rows of a key apart. Rows without a key belong nowhere and are left out.
    ``value`` may be a list of columns for a struct of them: those in ``order`` then travel once.
    """
    df = df.filter(F.col(key).isNotNull())
    if page_rows is None:  # grouped by the key alone, so that a join on it shuffles no array again
        return df.groupBy(key).agg(_sorted_values(order, value).alias(name)).select(key, F.lit(0).alias("page"), name)
    if page_rows < 1:
        raise ValueError("page_rows must be 1 or more")
    made = df.select(key, *order, (F.struct(*value) if isinstance(value, list) else value).alias("_value"))
    made = numbered(made, key, order, "_number")
    paged, value = made.withColumn("page", F.floor(F.col("_number") / page_rows).cast("int")), F.col("_value")
    return paged.groupBy(key, "page").agg(_sorted_values(order, value).alias(name))


def attach_sorted(
    left: DataFrame,
    df: DataFrame,
    key: str,
    order: list[str],
    value: Column | list[str],
    name: str,
    page_rows: int | None = None,
) -> DataFrame:
    """``left`` beside the arrays of ``collect_sorted``, with their page; none gives an empty one.

    A row of ``left`` appears once per page, and a key's pages are joined by many tasks.
    """
    pages = collect_sorted(df, key, order, value, name, page_rows)
    if page_rows is None:
        joined = left.join(pages, key, "left")
    else:
        pages = rest(pages, "pages").frame
        last = pages.groupBy(key).agg(F.max("page").alias("_last"))
        numbers = F.explode(F.sequence(F.lit(0), F.coalesce("_last", F.lit(0))))
        joined = left.join(last, key, "left").withColumn("page", numbers).drop("_last").join(pages, [key, "page"], "left")
        joined = joined.select(*left.columns, "page", name)
    return joined.withColumns({"page": F.coalesce("page", F.lit(0)), name: F.coalesce(name, F.array())})
