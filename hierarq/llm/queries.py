"""Queries of the training-data operators, and SQL for those that SQL can express.

Every query reads its whole tables. The SQL states the required rows by a plainer way and
is run by another engine to check them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hierarq.common import table
from hierarq.llm import canonical_values, mix, quantiles, scan_repair, split, tokenize, truncation


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Blocks that the splitter cuts into more than one piece."""
    cut = split.pieces(table(spark, d, "text_blocks"), oversized_only=True)
    return cut.where("piece_no = 0 AND n_pieces > 1").select("block_id")


def p1_pieces(spark: SparkSession, d: str) -> DataFrame:
    return split.pieces(table(spark, d, "text_blocks"), oversized_only=True)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return scan_repair.noise(table(spark, d, "text_blocks"), table(spark, d, "detected_elements"))


def p2_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    return scan_repair.paragraphs(table(spark, d, "text_blocks"), table(spark, d, "detected_elements"))


def p4_percentiles(spark: SparkSession, d: str) -> DataFrame:
    return quantiles.latency_percentiles(table(spark, d, "llm_call_metrics"))


def p4_measured(spark: SparkSession, d: str) -> DataFrame:
    """How many calls each percentile is made of: the exact part of problem 4."""
    return quantiles.measured_calls(table(spark, d, "llm_call_metrics")).groupBy("stage", "model_id").agg(
        F.count("*").alias("n"), F.min("latency_ms").alias("low"), F.max("latency_ms").alias("high"))


def _typed_bands(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "detected_elements").select(F.lit("detected_elements").alias("table_name"),
                                                    F.col("element_id").alias("row_id"), "age_band")
    b = table(spark, d, "source_documents").select(F.lit("source_documents").alias("table_name"),
                                                   F.col("id").alias("row_id"), "age_band")
    return a.unionByName(b).where("row_id IS NOT NULL")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return canonical_values.map_to_bands(_typed_bands(spark, d), table(spark, d, "age_bands")).select(
        "table_name", "row_id", "band_id")


def p7_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """Values that mean no entry, with how many rows hold them."""
    got = canonical_values.map_to_bands(_typed_bands(spark, d), table(spark, d, "age_bands"))
    return got.where("band_id = 0").groupBy("table_name", "age_band").agg(F.count("*").alias("n"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokenize.encode_corpus(table(spark, d, "documents"))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mix.actual_shares(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mix.mixture(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return truncation.truncated(table(spark, d, "documents"))


def p10_shares(spark: SparkSession, d: str) -> DataFrame:
    return truncation.truncation_shares(table(spark, d, "documents"))


def p10_reasons(spark: SparkSession, d: str) -> DataFrame:
    return truncation.truncation_reasons(table(spark, d, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found, "p1_pieces": p1_pieces, "p2_found": p2_found, "p2_paragraphs": p2_paragraphs,
    "p4_percentiles": p4_percentiles, "p4_measured": p4_measured, "p7_found": p7_found, "p7_unmatched": p7_unmatched,
    "p8_ids": p8_ids, "p9_mixture": p9_mixture, "p9_shares": p9_shares, "p10_found": p10_found, "p10_shares": p10_shares,
    "p10_reasons": p10_reasons,
}

SQL: dict[str, str] = {
    "p1_found": """
        SELECT DISTINCT block_id FROM text_blocks WHERE length(text) // 4 > 2000""",
    "p4_measured": """
        SELECT stage, model_id, count(*) AS n, min(latency_ms) AS low, max(latency_ms) AS high
        FROM (SELECT DISTINCT call_id, stage, model_id, latency_ms FROM llm_call_metrics)
        WHERE latency_ms IS NOT NULL AND NOT isnan(latency_ms) AND latency_ms >= 0 AND NOT isinf(latency_ms)
        GROUP BY stage, model_id""",
}
