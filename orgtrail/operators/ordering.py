"""Report order."""

from pyspark.sql import DataFrame


def sort_report(df: DataFrame) -> DataFrame:
    """By company, then year; a company without accounts comes first in its own place."""
    return df.orderBy("vat", "year")
