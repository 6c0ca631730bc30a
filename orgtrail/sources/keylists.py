"""Key lists: the companies a report is about."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orgtrail.functions.text import nonblank
from orgtrail.operators.grouping import distinct

CSV_SEPARATOR = ";"


def clean_keys(keys: DataFrame, column: str) -> DataFrame:
    """Trimmed distinct keys as ``vat``, without blanks."""
    trimmed = keys.select(F.trim(F.col(f"`{column}`")).alias("vat"))
    return distinct(trimmed.filter(nonblank(F.col("vat"))))


def read_vat_list(
    spark: SparkSession, path: str, sep: str = CSV_SEPARATOR, column: str | None = None
) -> DataFrame:
    """A key list from CSV with a header.

    With ``column`` the file must have it. Without, the column called vat in any case is
    taken, else the first.
    """
    raw = spark.read.option("header", True).option("sep", sep).csv(path)
    if column is None:
        named = [name for name in raw.columns if name.lower() == "vat"]
        column = named[0] if named else raw.columns[0]
    elif column not in raw.columns:
        raise ValueError(f"{path} has no column {column!r}: {raw.columns}")
    return clean_keys(raw, column)


def vat_list(spark: SparkSession, values) -> DataFrame:
    """A literal key list."""
    keys = F.lit(list(values)).cast("array<string>")
    return distinct(spark.range(1).select(F.explode(keys).alias("vat")))


def key_in(key: Column, values) -> Column:
    """Membership in a literal list, which reaches the Parquet scan as a filter."""
    return key.isin(list(values))
