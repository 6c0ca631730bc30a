"""The corpus pipeline: what it keeps of ``documents``, in stages that each build on the last.

Rejected documents leave first, then one document of each near-duplicate group stays, leaks of
the benchmark leave, the sources are mixed to their weights, and the rest goes into shards.

Edge cases: a null or empty text has the score of the model's bias and is no one's copy; it is
in no mix, so the last stage never sees it. A row with a null doc_id is scored, is the last choice
among near duplicates and mixes like any other. Without labels nothing is rejected, without
benchmark items nothing leaks, and an empty table gives no rows.
"""

from pyspark.sql import DataFrame, SparkSession

from orgtrail.llm import decontamination, mixing, ngram_join, quality, sharding
from orgtrail.llm.common import at_rest, read_table


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    model = quality.fit_quality(quality.training_part(docs), read_table(spark, sf_dir, "labels"))
    return quality.accepted(docs, model)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates on five-word shingles, the smallest doc_id."""
    return ngram_join.one_of_each(docs, percent=80, words=5)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.without_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out, so that sources come near their target weights."""
    return mixing.mixed_documents(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and slot."""
    return sharding.assign_shards(docs)


STAGES = [
    ("quality", good),
    ("near_duplicates", distinct_texts),
    ("decontamination", clean),
    ("mixing", mixed),
    ("sharding", sharded),
]

#: Trained models and similarity components are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = at_rest(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
