"""The registered queries of this package: one per operator, over whole tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orgtrail.llm import (
    codebooks,
    decontamination,
    fingerprints,
    language,
    lexical,
    line_dedup,
    lm_scoring,
    mixing,
    ngram_join,
    pii,
    quality,
    sharding,
    token_counts,
)
from orgtrail.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scoring": lambda spark, d: lm_scoring.lm_report(read_table(spark, d, "documents")),
    "op2_document_fingerprints": lambda spark, d: fingerprints.fingerprint_edits(read_table(spark, d, "documents")),
    "op3_token_counts": lambda spark, d: token_counts.token_report(read_table(spark, d, "documents")),
    "op4_ngram_jaccard_join": lambda spark, d: ngram_join.jaccard_components(read_table(spark, d, "documents")),
    "op5_quality_classifier": lambda spark, d: quality.quality_report(
        read_table(spark, d, "documents"), read_table(spark, d, "labels")
    ),
    "op6_benchmark_decontamination": lambda spark, d: decontamination.find_leaks(
        read_table(spark, d, "documents"), read_table(spark, d, "benchmark")
    ),
    "op7_language_id": lambda spark, d: language.language_report(read_table(spark, d, "documents")),
    "op8_source_mixing": lambda spark, d: mixing.mix(read_table(spark, d, "documents")),
    "op9_line_dedup": lambda spark, d: line_dedup.line_report(read_table(spark, d, "documents")),
    "op10_sharding": lambda spark, d: sharding.shard_report(read_table(spark, d, "documents")),
    "op11_pii": lambda spark, d: pii.pii_report(read_table(spark, d, "documents")),
    "op12_vector_codes": lambda spark, d: codebooks.vector_code_report(read_table(spark, d, "embeddings")),
    "op13_ranked_search": lambda spark, d: lexical.ranked_search(
        read_table(spark, d, "documents"), read_table(spark, d, "benchmark")
    ),
}

ORACLES: dict[str, str] = {
    "op12_vector_codes": codebooks.ORACLE,
    "op13_ranked_search": lexical.ORACLE,
}
