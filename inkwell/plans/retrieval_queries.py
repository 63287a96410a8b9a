"""Queries over units and questions: index, ranking, fusion, packing, metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkwell.operators import metrics, retrieval, units
from inkwell.plans import base as B
from inkwell.plans import hybrid
from inkwell.session import checkpoint, table

Q: dict[str, tuple] = {}
R9 = lambda c: F.round(c, 6)


def query(name: str, sql: str | None = None):
    def add(f):
        Q[name] = (f, sql)
        return f

    return add


def t0(s, d) -> DataFrame:
    return units.fixed_chunks(B.atoms(s, d))


def bm25_hits(s, d, u: DataFrame, k: int = 50) -> DataFrame:
    """``u`` should be checkpointed: it is read for the frequencies, the blocks and the padding."""
    q = checkpoint(B.questions(s, d))
    best = checkpoint(retrieval.top_k(retrieval.bm25_top_k(u, q, k), k))
    return retrieval.padded(best, q, u, k)


def units_of(s, d) -> DataFrame:
    return checkpoint(t0(s, d))


_B = f"WITH RECURSIVE {B.T0}, {B.QUESTIONS}, {B.BM25}"
_TOP = "bt AS (SELECT question_id, unit_id, score, row_number() OVER (PARTITION BY question_id ORDER BY round(score, 9) DESC, unit_id) AS rank FROM ({}) QUALIFY rank <= 50)"
_PADDED = "SELECT question_id, unit_id, score FROM bm UNION ALL SELECT question_id, unit_id, 0.0::DOUBLE FROM (SELECT q.question_id, u.unit_id FROM qu q CROSS JOIN t0 u) x WHERE NOT EXISTS (SELECT 1 FROM bm WHERE bm.question_id = x.question_id AND bm.unit_id = x.unit_id)"
_HASH = "(SELECT {id}, list(coalesce(x, 0) ORDER BY i) AS e FROM (SELECT {id}, i FROM (SELECT DISTINCT {id} FROM {src}) CROSS JOIN (SELECT unnest(range(64)) AS i)) g LEFT JOIN (SELECT {id}, CAST(('0x' || substr(sha256(term), 1, 8)) AS BIGINT) % 64 AS i, sum(CASE WHEN substr(sha256(term), 9, 1) < '8' THEN 1.0::DOUBLE ELSE -1.0 END) AS x FROM (SELECT DISTINCT {id}, term FROM {src}) GROUP BY 1, 2) USING ({id}, i) GROUP BY {id})"
_OV = f"qv AS {_HASH.format(id='question_id', src='aq')}, uv AS {_HASH.format(id='unit_id', src='po')}, dn AS (SELECT question_id, unit_id, round(CASE WHEN list_dot_product(q.e, q.e) = 0 OR list_dot_product(u.e, u.e) = 0 THEN 0 ELSE list_dot_product(q.e, u.e) / (sqrt(list_dot_product(q.e, q.e)) * sqrt(list_dot_product(u.e, u.e))) END, 9) AS score FROM qv q CROSS JOIN uv u), ov AS (SELECT question_id, unit_id, score, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, unit_id) AS rank FROM dn QUALIFY rank <= 50)"
_RRF = "rr AS (SELECT question_id, unit_id, sum(1.0::DOUBLE / (60 + k)) AS score, row_number() OVER (PARTITION BY question_id ORDER BY round(sum(1.0::DOUBLE / (60 + k)), 9) DESC, unit_id) AS rank FROM (SELECT question_id, unit_id, rank AS k FROM bt UNION ALL SELECT question_id, unit_id, rank FROM ov) GROUP BY question_id, unit_id QUALIFY rank <= 50)"
_LISTS = f"{_B}, {_TOP.format(_PADDED)}, {_OV}, {_RRF}"


@query("q163_term_statistics", f"{_B} SELECT term, df, tf FROM (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS tf FROM po GROUP BY term)")
def _(s, d):
    return retrieval.postings(t0(s, d)).groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("tf"))


@query("q163_index_statistics", f"{_B} SELECT units, round(avgdl, 6) AS avgdl FROM st")
def _(s, d):
    return retrieval.index_statistics(retrieval.postings(t0(s, d))).select("units", R9("avgdl").alias("avgdl"))


@query("q096_bm25_top50", f"{_B}, {_TOP.format(_PADDED)} SELECT question_id, unit_id, rank, round(score, 6) AS score FROM bt")
def _(s, d):
    return bm25_hits(s, d, units_of(s, d)).select("question_id", "unit_id", F.col("rank").cast("long"), R9("score").alias("score"))


_COS = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings), n AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS l FROM v)
SELECT question_id, unit_id, round(score, 5) AS score, rank FROM (SELECT q.vec_id AS question_id, u.vec_id AS unit_id, round(CASE WHEN q.l = 0 OR u.l = 0 THEN 0 ELSE list_dot_product(q.e, u.e) / (q.l * u.l) END, 9) AS score, row_number() OVER (PARTITION BY q.vec_id ORDER BY round(CASE WHEN q.l = 0 OR u.l = 0 THEN 0 ELSE list_dot_product(q.e, u.e) / (q.l * u.l) END, 9) DESC, u.vec_id) AS rank FROM n q JOIN n u ON q.vec_id <> u.vec_id WHERE q.vec_id % 20 = 0) WHERE rank <= 10"""


@query("q097_cosine_top10", _COS)
def _(s, d):
    v = table(s, d, "embeddings")
    return retrieval.cosine_top_k(v, v.where("vec_id % 20 = 0"), 10).select("question_id", "unit_id", F.round("score", 5).alias("score"), F.col("rank").cast("long"))


@query("q168_label_precision", f"SELECT c.question_id, count(*) FILTER (WHERE a.label = b.label) / count(*) AS precision_at_10 FROM ({_COS}) c JOIN embeddings a ON a.vec_id = c.question_id JOIN embeddings b ON b.vec_id = c.unit_id GROUP BY 1")
def _(s, d):
    v = table(s, d, "embeddings")
    hits = retrieval.cosine_top_k(v, v.where("vec_id % 20 = 0"), 10)
    lab = v.select("vec_id", "label")
    j = hits.join(lab.select(F.col("vec_id").alias("question_id"), F.col("label").alias("ql")), "question_id").join(lab.select(F.col("vec_id").alias("unit_id"), F.col("label").alias("ul")), "unit_id")
    return j.groupBy("question_id").agg((F.count_if(F.col("ql") == F.col("ul")) / F.count("*")).alias("precision_at_10"))


def fused(s, d, u: DataFrame) -> DataFrame:
    lists = bm25_hits(s, d, u).select("question_id", "unit_id", "rank").unionByName(retrieval.dense_hits(u, B.questions(s, d), 50).select("question_id", "unit_id", "rank"))
    return retrieval.fuse(lists)


@query("q173_dense_top50", f"{_B}, {_OV} SELECT question_id, unit_id, rank, round(score, 6) AS score FROM ov")
def _(s, d):
    return retrieval.dense_hits(units_of(s, d), B.questions(s, d), 50).select("question_id", "unit_id", F.col("rank").cast("long"), R9("score").alias("score"))


@query("q173_hybrid_trace", f"{_B}, {_TOP.format(_PADDED)}, {_OV}, {_RRF}, tr AS (SELECT question_id, unit_id, rank, 'sparse' AS stage FROM bt UNION ALL SELECT question_id, unit_id, rank, 'dense' FROM ov UNION ALL SELECT question_id, unit_id, rank, 'fused' FROM rr) SELECT stage, question_id, count(*) AS hits, min(unit_id) FILTER (WHERE rank = 1) AS best, CAST(max(rank) AS BIGINT) AS longest FROM tr GROUP BY 1, 2")
def _(s, d):
    """The pipeline of ``hybrid`` with its dense stage, all questions in one plan; its trace up to fusion."""
    t = hybrid.trace(B.questions(s, d), units_of(s, d)).where("stage <> 'reranked'")
    return t.groupBy("stage", "question_id").agg(F.count("*").alias("hits"), F.min(F.when(F.col("rank") == 1, F.col("unit_id"))).alias("best"), F.max("rank").cast("long").alias("longest"))


@query("q170_rank_fusion", f"{_LISTS} SELECT question_id, unit_id, rank, round(score, 6) AS score FROM rr")
def _(s, d):
    return fused(s, d, units_of(s, d)).select("question_id", "unit_id", F.col("rank").cast("long"), R9("score").alias("score"))


_RERANK = """, rk AS (SELECT rr.question_id, rr.unit_id, rr.rank AS fused_rank, count(DISTINCT po.term) / nullif(any_value(n.k), 0)::DOUBLE AS score FROM rr JOIN (SELECT question_id, count(DISTINCT term) AS k FROM aq GROUP BY 1) n USING (question_id) LEFT JOIN (SELECT DISTINCT question_id, term FROM aq) a ON a.question_id = rr.question_id LEFT JOIN po ON po.unit_id = rr.unit_id AND po.term = a.term GROUP BY 1, 2, 3),
rt AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY round(score, 9) DESC, fused_rank, unit_id) AS rank FROM rk QUALIFY rank <= 20)"""


@query("q172_rerank", f"{_LISTS}{_RERANK} SELECT question_id, unit_id, fused_rank, rank, round(score, 6) AS score FROM rt")
def _(s, d):
    u = checkpoint(t0(s, d))
    r = retrieval.rerank(fused(s, d, u), B.questions(s, d), u)
    return r.select("question_id", "unit_id", F.col("fused_rank").cast("long"), F.col("rank").cast("long"), R9("score").alias("score"))


_PACK = """, rq AS (SELECT rt.question_id, rt.rank AS pos, rt.unit_id, length(t0.retrieval_text) AS n FROM rt JOIN t0 USING (unit_id)),
ck AS (SELECT question_id, pos, unit_id, CASE WHEN n <= 4000 THEN n ELSE 0 END AS used, n <= 4000 AS took FROM rq WHERE pos = 1
 UNION ALL SELECT r.question_id, r.pos, r.unit_id, CASE WHEN c.used = 0 THEN CASE WHEN r.n <= 4000 THEN r.n ELSE 0 END WHEN c.used + r.n + 2 <= 4000 THEN c.used + r.n + 2 ELSE c.used END, CASE WHEN c.used = 0 THEN r.n <= 4000 ELSE c.used + r.n + 2 <= 4000 END FROM ck c JOIN rq r ON r.question_id = c.question_id AND r.pos = c.pos + 1)"""


@query("q175_context_packing", f"{_LISTS}{_RERANK}{_PACK} SELECT question_id, string_agg(unit_id, '|' ORDER BY pos) FILTER (WHERE took) AS unit_ids, max(used) AS token_count, count(*) FILTER (WHERE NOT took) AS skipped FROM ck GROUP BY 1")
def _(s, d):
    u = checkpoint(t0(s, d))
    r = retrieval.rerank(fused(s, d, u), B.questions(s, d), u)
    ranked = r.join(u.select("unit_id", "context_id", F.char_length("context_text").alias("n")), "unit_id")
    return units.pack_context(ranked, 4000).select("question_id", F.array_join("unit_ids", "|").alias("unit_ids"), F.col("token_count").cast("long"), F.size("skipped").cast("long").alias("skipped"))


_GOLD = ", gd AS (SELECT filename AS question_id, 1 AS set_id, atom_id FROM (SELECT filename, unnest(list_distinct(source_blocks)) AS block_id FROM lc WHERE title IS NOT NULL) JOIN atm USING (block_id))"


def ranked_atoms(s, d, u: DataFrame, k: int = 50) -> DataFrame:
    return bm25_hits(s, d, u, k).join(u.select("unit_id", F.col("retrieval_atoms").alias("atoms")), "unit_id")


@query("q178_atom_metrics", f"""{_B}{_GOLD}, {_TOP.format(_PADDED)}, ra AS (SELECT question_id, rank, unnest(atoms) AS atom_id, unnest(range(1, len(atoms) + 1)) AS i FROM bt JOIN t0 USING (unit_id) WHERE rank <= 10),
 pl AS (SELECT question_id, atom_id, row_number() OVER (PARTITION BY question_id ORDER BY min(rank * 100000 + i)) AS position FROM ra GROUP BY 1, 2), g AS (SELECT DISTINCT question_id, atom_id FROM gd), rn AS (SELECT question_id, count(*) AS returned FROM pl GROUP BY 1),
 ev AS (SELECT g.question_id, count(*) AS n_gold, count(position) AS found, min(position) AS first, sum(3.0::DOUBLE / log2(position + 1.0::DOUBLE)) AS dcg FROM g LEFT JOIN pl ON g.question_id = pl.question_id AND g.atom_id = pl.atom_id GROUP BY 1)
 SELECT question_id, round(found / n_gold, 6) AS recall, CAST(found = n_gold AS INT) AS complete, round(coalesce(1.0::DOUBLE / first, 0), 6) AS mrr, round(coalesce(dcg, 0) / list_sum(list_transform(range(1, least(n_gold, returned) + 1), lambda i: 3.0::DOUBLE / log2(i + 1.0::DOUBLE))), 6) AS ndcg, round(found / returned, 6) AS precision FROM ev JOIN rn USING (question_id)""")
def _(s, d):
    u = checkpoint(t0(s, d))
    m = metrics.atom_metrics(ranked_atoms(s, d, u), B.gold(s, d), 10)
    return m.select("question_id", R9("recall").alias("recall"), "complete", R9("mrr").alias("mrr"), R9("ndcg").alias("ndcg"), R9("precision").alias("precision"))


_UNIT = f"""{_B}{_GOLD}, {_TOP.format(_PADDED)}, g AS (SELECT DISTINCT question_id, atom_id FROM gd), hh AS (SELECT b.question_id, b.rank, x.atom_id FROM bt b JOIN (SELECT unit_id, unnest(atoms) AS atom_id FROM t0) x USING (unit_id) JOIN g ON g.question_id = b.question_id AND g.atom_id = x.atom_id),
 ba AS (SELECT question_id, atom_id, min(rank) AS rank FROM hh GROUP BY 1, 2), rc AS (SELECT question_id, count(*) FILTER (WHERE rank <= 5) AS f5, count(*) FILTER (WHERE rank <= 10) AS f10, count(*) FILTER (WHERE rank <= 20) AS f20, count(*) FILTER (WHERE rank <= 50) AS f50, min(rank) AS first FROM ba GROUP BY 1),
 dg AS (SELECT question_id, sum(1.0::DOUBLE / log2(rank + 1.0::DOUBLE)) AS dcg, count(*) AS relevant FROM (SELECT DISTINCT question_id, rank FROM hh) GROUP BY 1), ng AS (SELECT question_id, count(*) AS n FROM g GROUP BY 1),
 um AS (SELECT ng.question_id, coalesce(f5, 0) / n AS recall_5, coalesce(f10, 0) / n AS recall_10, coalesce(f20, 0) / n AS recall_20, coalesce(f50, 0) / n AS recall_50, coalesce(1.0::DOUBLE / first, 0) AS mrr, coalesce(dcg / list_sum(list_transform(range(1, relevant + 1), lambda i: 1.0::DOUBLE / log2(i + 1.0::DOUBLE))), 0) AS ndcg FROM ng LEFT JOIN rc USING (question_id) LEFT JOIN dg USING (question_id))"""


@query("q179_unit_metrics", f"{_UNIT} SELECT question_id, round(recall_5, 6) AS recall_5, round(recall_10, 6) AS recall_10, round(recall_20, 6) AS recall_20, round(recall_50, 6) AS recall_50, round(mrr, 6) AS mrr, round(ndcg, 6) AS ndcg FROM um")
def _(s, d):
    u = checkpoint(t0(s, d))
    m = metrics.unit_metrics(ranked_atoms(s, d, u), B.gold(s, d))
    return m.select("question_id", *[R9(c).alias(c) for c in m.columns[1:]])


@query("q065_macro_means", f"{_UNIT} SELECT 'T0' AS arm, count(*) AS questions, round(avg(recall_10), 5) AS recall_10, round(avg(mrr), 5) AS mrr, round(avg(ndcg), 5) AS ndcg FROM um")
def _(s, d):
    u = checkpoint(t0(s, d))
    m = metrics.unit_metrics(ranked_atoms(s, d, u), B.gold(s, d))
    return m.agg(F.lit("T0").alias("arm"), F.count("*").alias("questions"), *[F.round(F.avg(c), 5).alias(c) for c in ("recall_10", "mrr", "ndcg")])


@query("q174_three_arms")
def _(s, d):
    """Means of the three arms under one configuration."""
    a = checkpoint(B.atoms(s, d))
    arms = [units.fixed_chunks(a), units.parent_child(a), units.concept_units(B.concepts(s, d), a)]
    out = None
    for name, u in zip(("T0", "T1", "C1"), arms):
        u = checkpoint(u)
        m = metrics.unit_metrics(ranked_atoms(s, d, u), B.gold(s, d)).agg(F.lit(name).alias("arm"), F.count("*").alias("questions"), *[F.round(F.avg(c), 5).alias(c) for c in ("recall_5", "recall_10", "recall_50", "mrr", "ndcg")])
        out = m if out is None else out.unionByName(m)
    return out


@query("q180_win_tie_loss")
def _(s, d):
    a = checkpoint(B.atoms(s, d))
    u, v = checkpoint(units.fixed_chunks(a)), checkpoint(units.parent_child(a))
    gold = B.gold(s, d)
    return metrics.win_tie_loss(metrics.unit_metrics(ranked_atoms(s, d, u), gold), metrics.unit_metrics(ranked_atoms(s, d, v), gold), "recall_10")


@query("q184_bootstrap", """WITH lp AS (SELECT * FROM page_results QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY recorded_at DESC NULLS LAST) = 1), p AS (SELECT record_id AS id, elapsed_ms::DOUBLE AS d, row_number() OVER (ORDER BY record_id) - 1 AS i FROM lp WHERE elapsed_ms IS NOT NULL), n AS (SELECT count(*) AS n FROM p),
 dr AS (SELECT s.range AS sample, CAST(('0x' || substr(sha256('42:' || s.range || ':' || k.range), 1, 15)) AS BIGINT) % (SELECT n FROM n) AS i FROM range(50) s, range((SELECT n FROM n)) k), ms AS (SELECT sample, sum(d) / (SELECT n FROM n) AS m FROM dr JOIN p USING (i) GROUP BY sample)
 SELECT (SELECT n FROM n) AS n, round((SELECT avg(d) FROM p), 3) AS mean, round(quantile_cont(m, 0.025), 3) AS low, round(quantile_cont(m, 0.975), 3) AS high FROM ms""")
def _(s, d):
    p = B.pages(s, d).where("elapsed_ms is not null").select(F.col("record_id").alias("id"), F.col("elapsed_ms").cast("double").alias("d"))
    return metrics.bootstrap(p, 50).select("n", *[F.round(c, 3).alias(c) for c in ("mean", "low", "high")])


@query("q184_paired_bootstrap")
def _(s, d):
    """Per question recall_10 of T1 less that of T0, over 10,000 resamples."""
    a = checkpoint(B.atoms(s, d))
    gold = B.gold(s, d)
    base, cand = (metrics.unit_metrics(ranked_atoms(s, d, checkpoint(arm(a))), gold) for arm in (units.fixed_chunks, units.parent_child))
    r = metrics.bootstrap(checkpoint(metrics.paired_differences(base, cand, "recall_10")), 10_000)
    return r.select("n", *[R9(c).alias(c) for c in ("mean", "low", "high")])


@query("q154_unit_tokens", f"WITH RECURSIVE {B.T0} SELECT unit_id, greatest(length(retrieval_text), 1) AS code_points, len({B.TOKENS.format('retrieval_text')}) AS words FROM t0")
def _(s, d):
    u = t0(s, d)
    return u.select("unit_id", F.greatest(F.char_length("retrieval_text"), F.lit(1)).cast("long").alias("code_points"), F.size(retrieval.tokens(F.col("retrieval_text"))).cast("long").alias("words"))


@query("q171_hit_validation", f"{_B}, {_TOP.format(_PADDED)} SELECT count(*) AS hits, count(DISTINCT question_id) AS questions, count(*) FILTER (WHERE score = 0) AS padded, CAST(max(rank) AS BIGINT) AS longest FROM bt")
def _(s, d):
    h = bm25_hits(s, d, units_of(s, d))
    return h.agg(F.count("*").alias("hits"), F.count_distinct("question_id").alias("questions"), F.count_if(F.col("score") == 0).alias("padded"), F.max("rank").cast("long").alias("longest"))
