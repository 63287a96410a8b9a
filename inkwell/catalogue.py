"""The engine's own queries over the test tables, with equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from inkwell.plans import contract_queries, evidence_queries, knowledge_queries, more_queries, retrieval_queries, structure_queries

AREAS = [structure_queries, retrieval_queries, knowledge_queries, more_queries, evidence_queries, contract_queries]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for area in AREAS for name, (f, _) in area.Q.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for area in AREAS for name, (_, sql) in area.Q.items() if sql}


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries()["q170_rank_fusion"](spark, sf_dir)
