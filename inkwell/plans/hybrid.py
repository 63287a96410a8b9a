"""The retrieval pipeline with exchangeable stages, all questions in one plan."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.functions.text import code_points
from inkwell.operators import retrieval, units
from inkwell.session import checkpoint


@dataclass(frozen=True)
class Config:
    """Budgets and constants of a run; equal configurations have equal fingerprints, so arms can be compared."""

    sparse_k: int = 50
    dense_k: int = 50
    fused_k: int = 50
    rerank_k: int = 20
    context_budget: int = 8192
    rrf_k: int = 60

    def fingerprint(self) -> str:
        return hashlib.sha256(json.dumps(asdict(self), sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def _bm25(questions: DataFrame, u: DataFrame, k: int) -> DataFrame:
    best = checkpoint(retrieval.top_k(retrieval.bm25_top_k(u, questions, k), k))
    return retrieval.padded(best, questions, u, k)


def _dense(questions: DataFrame, u: DataFrame, k: int) -> DataFrame:
    return retrieval.dense_hits(u, questions, k)


@dataclass(frozen=True)
class Backend:
    """The stages as functions on DataFrames: sparse(questions, units, k) and dense(questions, units, k) give question_id,
    unit_id, rank; rerank(hits, questions, units, k) reorders them; count_tokens is a column expression."""

    sparse: Callable[[DataFrame, DataFrame, int], DataFrame] = _bm25
    dense: Callable[[DataFrame, DataFrame, int], DataFrame] | None = _dense
    rerank: Callable[[DataFrame, DataFrame, DataFrame, int], DataFrame] = retrieval.rerank
    count_tokens: Callable[[Column], Column] = code_points


def trace(questions: DataFrame, u: DataFrame, backend: Backend | None = None, config: Config | None = None) -> DataFrame:
    """(question_id, stage, unit_id, rank, score) of all stages: sparse, dense if there is one, fused, reranked."""
    b, c = backend or Backend(), config or Config()
    cols = ["question_id", "unit_id", "rank", "score"]
    lists = [b.sparse(questions, u, c.sparse_k).select(*cols, F.lit("sparse").alias("stage"))]
    if b.dense:
        lists.append(b.dense(questions, u, c.dense_k).select(*cols, F.lit("dense").alias("stage")))
    ranked = lists[0]
    for x in lists[1:]:
        ranked = ranked.unionByName(x)
    fused = retrieval.fuse(ranked, c.rrf_k, c.fused_k)
    top = b.rerank(fused, questions, u, c.rerank_k)
    return ranked.unionByName(fused.select(*cols, F.lit("fused").alias("stage"))).unionByName(top.select(*cols, F.lit("reranked").alias("stage")))


def contexts(traced: DataFrame, u: DataFrame, backend: Backend | None = None, config: Config | None = None) -> DataFrame:
    """(question_id, unit_ids, token_count, skipped): reranked contexts packed under the budget."""
    b, c = backend or Backend(), config or Config()
    sized = u.select("unit_id", "context_id", b.count_tokens(F.col("context_text")).cast("int").alias("n"))
    return units.pack_context(traced.where("stage = 'reranked'").join(sized, "unit_id"), c.context_budget)


def experiment(questions: DataFrame, arms: dict[str, DataFrame], done: DataFrame | None = None, backend: Backend | None = None, config: Config | None = None) -> DataFrame:
    """The trace of several arms under one fingerprint. Pairs of question and arm in ``done`` (of the same fingerprint) are not
    run again, so an interrupted experiment goes on where its written rows end."""
    c = config or Config()
    out = None
    for arm, u in sorted(arms.items()):
        q = questions
        if done is not None:
            q = q.join(done.where((F.col("arm") == arm) & (F.col("fingerprint") == c.fingerprint())).select("question_id").distinct(), "question_id", "left_anti")
        t = trace(q, u, backend, c).withColumn("arm", F.lit(arm)).withColumn("fingerprint", F.lit(c.fingerprint()))
        out = t if out is None else out.unionByName(t)
    return out
