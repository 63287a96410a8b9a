"""The training-data queries over the test tables, and SQL for those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from inkwell.llm import encoding, markup, mixing, near_duplicates, personal, repetition, scan_noise, splitting, truncation
from inkwell.session import checkpoint, table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return truncation.found(table(spark, d, "page_results"))


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    return truncation.report(truncation.scored(table(spark, d, "page_results")))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicates.found(table(spark, d, "blocks"))


def p2_groups(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicates.block_groups(table(spark, d, "blocks"), table(spark, d, "evidence_atoms"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return repetition.found(table(spark, d, "blocks"), table(spark, d, "page_results"))


def p3_shares(spark: SparkSession, d: str) -> DataFrame:
    return repetition.repeated_share(repetition.items(table(spark, d, "blocks"), table(spark, d, "page_results")))


def _scanned(spark: SparkSession, d: str) -> DataFrame:
    return scan_noise.items(table(spark, d, "blocks"), table(spark, d, "page_results"), table(spark, d, "excluded_fragments"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return scan_noise.found(table(spark, d, "blocks"), table(spark, d, "page_results"), table(spark, d, "excluded_fragments"))


def p4_repaired(spark: SparkSession, d: str) -> DataFrame:
    return scan_noise.repaired(_scanned(spark, d))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return markup.found(table(spark, d, "blocks"), table(spark, d, "concept_documents"))


def p5_clean(spark: SparkSession, d: str) -> DataFrame:
    return markup.converted(markup.items(table(spark, d, "blocks"), table(spark, d, "concept_documents")))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return splitting.found(table(spark, d, "article_segments"), table(spark, d, "split_limits"))


def p6_pieces(spark: SparkSession, d: str) -> DataFrame:
    return splitting.split_items(table(spark, d, "article_segments"), table(spark, d, "split_limits"))


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return encoding.encode(table(spark, d, "documents"))


def _sized(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    counted = checkpoint(encoding.encode(docs, counts_only=True))
    return docs.select("doc_id", "source").join(counted, "doc_id")


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(_sized(spark, d), table(spark, d, "mix_targets"))


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    targets = table(spark, d, "mix_targets")
    return mixing.shares(mixing.mix(_sized(spark, d), targets), targets)


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return personal.found(table(spark, d, "documents"))


def p9_redacted(spark: SparkSession, d: str) -> DataFrame:
    return personal.redacted(table(spark, d, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name[:1] == "p" and name[1:2].isdigit() and callable(f)}


P6_FOUND = """
SELECT DISTINCT segment_id FROM article_segments
WHERE length(content) > (SELECT max(max_chars) FROM split_limits WHERE profile = 'standard')
"""


def oracle_sql() -> dict[str, str]:
    return {"p6_found": P6_FOUND}
