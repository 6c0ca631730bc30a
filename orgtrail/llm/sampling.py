"""Bounded samples of labelled rows, on which classifiers are fitted."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_rows(ids: DataFrame, most: int) -> DataFrame:
    """At most ``most`` ids of a table of doc_ids, the first by MD5: the same at every run.

    Only ids are put in order; texts are fetched for the chosen ones.
    """
    key = F.md5(F.col("doc_id").cast("string").cast("binary"))
    return ids.select("doc_id").filter("doc_id is not null").distinct().orderBy(key, "doc_id").limit(most)
