"""Queries over concepts, versions, claims, graphs, telemetry and audits."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkwell.functions import text as X
from inkwell.operators import metrics, records, resolve, versioning
from inkwell.plans import base as B
from inkwell.session import checkpoint, table

Q: dict[str, tuple] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        Q[name] = (f, sql)
        return f

    return add


def refs(s, d):
    """Every concept as a typed mention; its article is the smallest document of its blocks."""
    c = B.concepts(s, d)
    b = c.select("filename", F.explode_outer(F.array_distinct("source_blocks")).alias("block_id")).join(B.blocks(s, d).select("block_id", "document_id"), "block_id", "left").groupBy("filename").agg(F.min("document_id").alias("article_id"))
    return c.join(b, "filename").select(F.col("filename").alias("ref_id"), F.col("concept_type").alias("kind"), F.coalesce("article_id", F.lit("")).alias("article_id"), F.coalesce("title", F.lit("")).alias("text"))


_REFS = f"{B.CONCEPTS}, {B.BLOCKS}, ar AS (SELECT filename, min(document_id) AS article_id FROM (SELECT filename, unnest(CASE WHEN len(source_blocks) > 0 THEN list_distinct(source_blocks) ELSE [NULL] END) AS block_id FROM lc) x LEFT JOIN lb USING (block_id) GROUP BY 1), rf AS (SELECT lc.filename AS ref_id, concept_type AS kind, coalesce(article_id, '') AS article_id, coalesce(title, '') AS text FROM lc JOIN ar ON ar.filename = lc.filename)"
_STOP = ", ".join(f"'{w}'" for w in X.STOPWORDS)
_TERMS = f"tm AS (SELECT DISTINCT ref_id, kind, article_id, lower(run) AS term FROM rn UNION SELECT ref_id, kind, article_id, substr(run, i, 2) FROM (SELECT *, unnest(range(1, length(run))) AS i FROM rn WHERE regexp_matches(run, '^[\\x{{3400}}-\\x{{9fff}}]{{2,}}$')))"
_RUNS = f"rn AS (SELECT ref_id, kind, article_id, run FROM (SELECT ref_id, kind, article_id, unnest(regexp_extract_all(text, '([A-Za-z0-9]{{2,}}|[\\x{{3400}}-\\x{{9fff}}]{{2,}})', 1)) AS run FROM rf) WHERE lower(run) NOT IN ({_STOP}))"
_EDGES = f"""{_REFS}, {_RUNS}, {_TERMS}, sz AS (SELECT ref_id, count(*) AS n FROM tm GROUP BY 1), sc AS (SELECT a.ref_id AS l, b.ref_id AS r, count(*) / (any_value(x.n) + any_value(y.n) - count(*))::DOUBLE AS score FROM tm a JOIN tm b ON a.kind = b.kind AND a.term = b.term AND a.ref_id < b.ref_id AND a.article_id <> b.article_id JOIN sz x ON x.ref_id = a.ref_id JOIN sz y ON y.ref_id = b.ref_id GROUP BY 1, 2),
 bo AS (SELECT l AS ref_id, r AS other, score FROM sc WHERE score >= 0.06 UNION ALL SELECT r, l, score FROM sc WHERE score >= 0.06), kp AS (SELECT * FROM bo QUALIFY row_number() OVER (PARTITION BY ref_id ORDER BY round(score, 9) DESC, other) <= 8), ed AS (SELECT least(ref_id, other) AS left_ref, greatest(ref_id, other) AS right_ref, max(score) AS score FROM kp GROUP BY 1, 2)"""


@query("q113_term_sets", f"WITH {_REFS}, {_RUNS}, {_TERMS} SELECT ref_id, string_agg(term, '|' ORDER BY term) AS terms FROM tm GROUP BY 1")
def _(s, d):
    return refs(s, d).select("ref_id", F.array_join(X.term_set(F.col("text")), "|").alias("terms")).where("terms <> ''")


@query("q189_candidate_edges", f"WITH {_EDGES} SELECT left_ref, right_ref, round(score, 6) AS score FROM ed")
def _(s, d):
    return resolve.candidate_edges(refs(s, d)).select("left_ref", "right_ref", F.round("score", 6).alias("score"))


@query("q191_components", f"WITH RECURSIVE {_EDGES}, un AS (SELECT left_ref AS a, right_ref AS b FROM ed UNION SELECT right_ref, left_ref FROM ed), rc AS (SELECT a AS node, a AS reach FROM un UNION SELECT rc.node, un.b FROM rc JOIN un ON rc.reach = un.a) SELECT node, min(reach) AS component FROM rc GROUP BY 1")
def _(s, d):
    return resolve.components(resolve.candidate_edges(refs(s, d)))


@query("q190_constrained_clusters")
def _(s, d):
    e = resolve.candidate_edges(refs(s, d))
    decision = F.when(F.col("score") >= 0.5, "same").when(F.col("score") >= 0.3, "complementary").when(F.col("score") >= 0.1, "related").otherwise("separate")
    return resolve.constrained_clusters(e.select(X.stable_id("edge", F.col("left_ref"), F.col("right_ref")).alias("edge_id"), "left_ref", "right_ref", decision.alias("decision")))


@query("q192_component_chunks")
def _(s, d):
    c = resolve.components(resolve.candidate_edges(refs(s, d)))
    w = B.concepts(s, d).select(F.col("filename").alias("node"), F.char_length(F.coalesce("body", F.lit(""))).alias("weight"))
    return resolve.partition_components(c.join(w, "node"))


_PLAN = "pn AS (SELECT ref_id, kind || '-' || substr(sha256(text), 1, 2) AS group_id FROM rf WHERE substr(sha256(ref_id), 1, 1) <> '0')"


@query("q193_plan_validation", f"WITH {_REFS}, {_PLAN}, j AS (SELECT pn.group_id, pn.ref_id, rf.kind, rf.article_id, count(*) OVER (PARTITION BY pn.ref_id) AS times FROM pn LEFT JOIN rf USING (ref_id)), ok AS (SELECT group_id FROM j GROUP BY 1 HAVING NOT bool_or(kind IS NULL OR times > 1) AND count(DISTINCT kind) = 1 AND (count(*) = 1 OR count(DISTINCT article_id) >= 2)) SELECT rf.ref_id, CASE WHEN ok.group_id IS NOT NULL THEN pn.group_id ELSE 'single-' || rf.ref_id END AS group_id, CASE WHEN ok.group_id IS NOT NULL THEN 'kept' WHEN pn.ref_id IS NOT NULL THEN 'demoted' ELSE 'added' END AS status FROM rf LEFT JOIN pn USING (ref_id) LEFT JOIN ok USING (group_id)")
def _(s, d):
    r = checkpoint(refs(s, d))
    plan = r.where(F.substring(F.sha2("ref_id", 256), 1, 1) != "0").select("ref_id", F.concat("kind", F.lit("-"), F.substring(F.sha2("text", 256), 1, 2)).alias("group_id"))
    return resolve.validated_plan(plan, r.select("ref_id", "kind", "article_id"))


@query("q046_ref_blocks", f"WITH {B.CONCEPTS}, {B.BLOCKS}, r AS (SELECT filename, unnest(source_blocks) AS block_id FROM lc) SELECT filename, count(*) AS refs, count(lb.block_id) AS resolved, count(*) FILTER (WHERE lb.block_id IS NULL) AS dangling FROM r LEFT JOIN lb USING (block_id) GROUP BY 1")
def _(s, d):
    r = B.concepts(s, d).select("filename", F.explode("source_blocks").alias("block_id"))
    j = r.join(B.blocks(s, d).select("block_id", F.lit(1).alias("hit")), "block_id", "left")
    return j.groupBy("filename").agg(F.count("*").alias("refs"), F.count("hit").alias("resolved"), F.count_if(F.col("hit").isNull()).alias("dangling"))


@query("q047_block_groups", f"WITH {B.CONCEPTS} SELECT block_id, count(DISTINCT filename) AS concepts, min(filename) AS first_concept FROM (SELECT filename, unnest(source_blocks) AS block_id FROM lc) GROUP BY 1")
def _(s, d):
    return B.concepts(s, d).select("filename", F.explode("source_blocks").alias("block_id")).groupBy("block_id").agg(F.count_distinct("filename").alias("concepts"), F.min("filename").alias("first_concept"))


@query("q053_page_overlap", f"WITH {B.SEGMENTS} SELECT a.segment_id AS left_id, b.segment_id AS right_id, least(a.page_end, b.page_end) - greatest(a.page_start, b.page_start) + 1 AS shared_pages FROM ls a JOIN ls b ON a.document_id = b.document_id AND a.ordinal < b.ordinal AND greatest(a.page_start, b.page_start) <= least(a.page_end, b.page_end)")
def _(s, d):
    x = B.segments(s, d).select("document_id", "segment_id", "ordinal", "page_start", "page_end")
    a, b = x.alias("a"), x.alias("b")
    j = a.join(b, (F.col("a.document_id") == F.col("b.document_id")) & (F.col("a.ordinal") < F.col("b.ordinal")) & (F.greatest("a.page_start", "b.page_start") <= F.least("a.page_end", "b.page_end")))
    return j.select(F.col("a.segment_id").alias("left_id"), F.col("b.segment_id").alias("right_id"), (F.least("a.page_end", "b.page_end") - F.greatest("a.page_start", "b.page_start") + 1).alias("shared_pages"))


@query("q061_elapsed_by_model", f"WITH {B.PAGES} SELECT model, count(v) AS n, sum(v) AS total, round(avg(v), 3) AS mean, quantile_cont(v, 0.5) AS p50, round(quantile_cont(v, 0.95), 3) AS p95, min(v) AS least, max(v) AS most FROM (SELECT model, elapsed_ms::DOUBLE AS v FROM lp) GROUP BY 1")
def _(s, d):
    x = records.distribution(B.pages(s, d), ["model"], "elapsed_ms")
    return x.withColumn("mean", F.round("mean", 3)).withColumn("p95", F.round("p95", 3))


@query("q062_event_values", "SELECT event_type, count(v) AS n, round(sum(v), 3) AS total, round(avg(v), 4) AS mean, round(quantile_cont(v, 0.5), 4) AS p50, round(quantile_cont(v, 0.95), 4) AS p95, round(min(v), 4) AS least, round(max(v), 4) AS most FROM (SELECT event_type, value::DOUBLE AS v FROM events) GROUP BY 1")
def _(s, d):
    x = records.distribution(table(s, d, "events"), ["event_type"], "value")
    return x.select("event_type", "n", F.round("total", 3).alias("total"), *[F.round(c, 4).alias(c) for c in ("mean", "p50", "p95", "least", "most")])


@query("q063_run_report", f"WITH {B.PAGES} SELECT model, count(*) AS records, count(DISTINCT document_id) AS documents, CAST(sum(attempts) AS BIGINT) AS attempts, count(*) FILTER (WHERE attempts > 1) AS retried, CAST(sum(prompt_tokens) AS BIGINT) AS prompt_tokens, CAST(sum(completion_tokens) AS BIGINT) AS completion_tokens, count(*) FILTER (WHERE completion_tokens IS NULL) AS unknown_tokens, count(*) FILTER (WHERE coalesce(content, '') = '') AS empty_pages FROM lp GROUP BY 1")
def _(s, d):
    return B.pages(s, d).groupBy("model").agg(F.count("*").alias("records"), F.count_distinct("document_id").alias("documents"), F.sum("attempts").alias("attempts"), F.count_if(F.col("attempts") > 1).alias("retried"), F.sum("prompt_tokens").cast("long").alias("prompt_tokens"), F.sum("completion_tokens").cast("long").alias("completion_tokens"), F.count_if(F.col("completion_tokens").isNull()).alias("unknown_tokens"), F.count_if(F.coalesce("content", F.lit("")) == "").alias("empty_pages"))


@query("q067_refusal_confusion", f"WITH {B.PAGES}, x AS (SELECT model, coalesce(regexp_matches(lower(finish_reason), 'len|max'), false) AS g, NOT regexp_matches(trim(coalesce(content, '')), '[.!?。]$') AS p FROM lp), c AS (SELECT model, count(*) FILTER (WHERE g AND p) AS tp, count(*) FILTER (WHERE NOT g AND p) AS fp, count(*) FILTER (WHERE g AND NOT p) AS fn, count(*) FILTER (WHERE NOT g AND NOT p) AS tn FROM x GROUP BY 1), r AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS pr, CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS re FROM c) SELECT model, tp, fp, fn, tn, round(pr, 6) AS precision, round(re, 6) AS recall, round(CASE WHEN pr + re = 0 THEN 0 ELSE 2 * pr * re / (pr + re) END, 6) AS f1 FROM r")
def _(s, d):
    g = F.coalesce(F.lower("finish_reason").rlike("len|max"), F.lit(False))
    x = B.pages(s, d).select("model", g.alias("g"), (~F.trim(F.coalesce("content", F.lit(""))).rlike("[.!?。]$")).alias("p"))
    c = metrics.confusion(x, "g", "p", ["model"])
    return c.select("model", "tp", "fp", "fn", "tn", *[F.round(n, 6).alias(n) for n in ("precision", "recall", "f1")])


@query("q068_corpus_counters", "SELECT lang, count(*) AS documents, count(*) FILTER (WHERE text IS NULL) AS null_texts, count(*) FILTER (WHERE text = '') AS empty_texts, count(*) FILTER (WHERE title IS NULL) AS untitled, count(*) FILTER (WHERE n_chars IS DISTINCT FROM length(text)) AS wrong_n_chars, CAST(sum(length(text)) AS BIGINT) AS chars, count(DISTINCT lower(trim(source))) AS sources FROM documents GROUP BY 1")
def _(s, d):
    t = table(s, d, "documents")
    return t.groupBy("lang").agg(F.count("*").alias("documents"), F.count_if(F.col("text").isNull()).alias("null_texts"), F.count_if(F.col("text") == "").alias("empty_texts"), F.count_if(F.col("title").isNull()).alias("untitled"), F.count_if(~F.col("n_chars").eqNullSafe(F.char_length("text").cast("long"))).alias("wrong_n_chars"), F.sum(F.char_length("text")).alias("chars"), F.count_distinct(F.lower(F.trim("source"))).alias("sources"))


@query("q069_merged_totals", f"WITH {B.PAGES}, m AS (SELECT date_trunc('month', recorded_at) AS month, model, total_tokens FROM lp WHERE recorded_at IS NOT NULL) SELECT month, CAST(sum(total_tokens) AS BIGINT) AS tokens, count(*) AS records, CAST(sum(sum(total_tokens)) OVER (ORDER BY month) AS BIGINT) AS running FROM m GROUP BY month")
def _(s, d):
    m = B.pages(s, d).where("recorded_at is not null").groupBy(F.date_trunc("month", "recorded_at").cast("timestamp_ntz").alias("month")).agg(F.sum("total_tokens").cast("long").alias("tokens"), F.count("*").alias("records"))
    return m.withColumn("running", F.sum("tokens").over(W.orderBy("month")))  # one row a month


@query("q070_graph_statistics", f"WITH {B.CONCEPTS}, {B.BLOCKS}, e AS (SELECT DISTINCT lc.filename, lc.concept_type, lb.document_id FROM (SELECT filename, concept_type, unnest(source_blocks) AS block_id FROM lc) lc JOIN lb USING (block_id)) SELECT concept_type, count(DISTINCT filename) AS concepts, count(*) AS edges, count(DISTINCT document_id) AS documents, count(*) FILTER (WHERE k > 1) AS multi_source_edges FROM (SELECT *, count(*) OVER (PARTITION BY filename) AS k FROM e) GROUP BY 1")
def _(s, d):
    r = B.concepts(s, d).select("filename", "concept_type", F.explode("source_blocks").alias("block_id")).join(B.blocks(s, d).select("block_id", "document_id"), "block_id")
    e = r.select("filename", "concept_type", "document_id").distinct().withColumn("k", F.count("*").over(W.partitionBy("filename")))
    return e.groupBy("concept_type").agg(F.count_distinct("filename").alias("concepts"), F.count("*").alias("edges"), F.count_distinct("document_id").alias("documents"), F.count_if(F.col("k") > 1).alias("multi_source_edges"))


@query("q071_edge_projection", "SELECT least(c.c_nationkey, s.s_nationkey) AS a, greatest(c.c_nationkey, s.s_nationkey) AS b, count(*) AS lines, count(DISTINCT l_orderkey) AS orders, round(sum(l_extendedprice), 2) AS value FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer c ON o_custkey = c_custkey JOIN supplier s ON l_suppkey = s_suppkey GROUP BY 1, 2")
def _(s, d):
    li = table(s, d, "lineitem").select("l_orderkey", "l_suppkey", "l_extendedprice")
    j = li.join(table(s, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey").join(table(s, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey").join(table(s, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"), "l_suppkey")
    return j.groupBy(F.least("c_nationkey", "s_nationkey").alias("a"), F.greatest("c_nationkey", "s_nationkey").alias("b")).agg(F.count("*").alias("lines"), F.count_distinct("l_orderkey").alias("orders"), F.round(F.sum("l_extendedprice"), 2).alias("value"))


@query("q072_ordered_merge", "SELECT document_id, count(*) AS deliveries, arg_min(title, processed_at) FILTER (WHERE title IS NOT NULL) AS title, arg_min(page_count, processed_at) FILTER (WHERE page_count IS NOT NULL) AS page_count, max(processed_at) AS last_processed FROM document_ir GROUP BY 1")
def _(s, d):
    t = table(s, d, "document_ir")
    return t.groupBy("document_id").agg(F.count("*").alias("deliveries"), records.first_non_null("title", "processed_at").alias("title"), records.first_non_null("page_count", "processed_at").alias("page_count"), F.max("processed_at").alias("last_processed"))


@query("q073_group_fold", f"WITH {B.CONCEPTS}, {B.BLOCKS} SELECT filename, min(page_idx) AS first_page, max(page_idx) AS last_page, count(DISTINCT lb.block_id) AS blocks, count(DISTINCT document_id) AS documents, min(array_to_string(heading_path, ' > ')) AS first_path FROM (SELECT filename, unnest(source_blocks) AS block_id FROM lc) r JOIN lb USING (block_id) GROUP BY 1")
def _(s, d):
    r = B.concepts(s, d).select("filename", F.explode("source_blocks").alias("block_id")).join(B.blocks(s, d), "block_id")
    return r.groupBy("filename").agg(F.min("page_idx").alias("first_page"), F.max("page_idx").alias("last_page"), F.count_distinct("block_id").alias("blocks"), F.count_distinct("document_id").alias("documents"), F.min(F.array_join("heading_path", " > ")).alias("first_path"))


@query("q075_strata_shortfall", f"WITH {B.ATOMS} SELECT article_id, block_type, count(*) AS have, greatest(3 - count(*), 0) AS shortfall FROM atm GROUP BY 1, 2")
def _(s, d):
    return B.atoms(s, d).groupBy("article_id", "block_type").agg(F.count("*").alias("have"), F.greatest(3 - F.count("*"), F.lit(0)).cast("long").alias("shortfall"))


@query("q076_link_classes", f"WITH {B.CONCEPTS}, {B.BLOCKS}, k AS (SELECT filename, source_blocks, unnest(regexp_extract_all(body, '\\[\\[(blk-[0-9a-f]+)\\]\\]', 1)) AS target FROM lc) SELECT CASE WHEN list_contains(source_blocks, target) THEN 'same_source' WHEN lb.block_id IS NOT NULL THEN 'cross_source' ELSE 'broken' END AS link_class, count(*) AS links, count(DISTINCT filename) AS concepts FROM k LEFT JOIN lb ON lb.block_id = k.target GROUP BY 1")
def _(s, d):
    k = B.concepts(s, d).select("filename", "source_blocks", F.explode(F.regexp_extract_all("body", F.lit(r"\[\[(blk-[0-9a-f]+)\]\]"), 1)).alias("target"))
    j = k.join(B.blocks(s, d).select(F.col("block_id").alias("target"), F.lit(True).alias("known")), "target", "left")
    c = F.when(F.array_contains("source_blocks", F.col("target")), "same_source").when(F.col("known"), "cross_source").otherwise("broken")
    return j.groupBy(c.alias("link_class")).agg(F.count("*").alias("links"), F.count_distinct("filename").alias("concepts"))


@query("q077_taxonomy_audit", f"WITH {B.CONCEPTS} SELECT concept_type, count(*) AS concepts, count(*) FILTER (WHERE title IS NULL) AS untitled, count(*) FILTER (WHERE frontmatter IS NULL) AS no_front_matter, count(*) FILTER (WHERE coalesce(len(source_blocks), 0) = 0) AS without_source, CAST(sum(length(body)) AS BIGINT) AS chars FROM lc GROUP BY 1")
def _(s, d):
    return B.concepts(s, d).groupBy("concept_type").agg(F.count("*").alias("concepts"), F.count_if(F.col("title").isNull()).alias("untitled"), F.count_if(F.col("frontmatter").isNull()).alias("no_front_matter"), F.count_if(F.coalesce(F.size("source_blocks"), F.lit(0)) <= 0).alias("without_source"), F.sum(F.char_length("body")).alias("chars"))


_COV = f"{B.PAGES}, cr AS (SELECT document_id, page_idx, attempts AS batch, CASE WHEN regexp_matches(lower(finish_reason), 'len|max|error') THEN 'contradicted' WHEN finish_reason IS NULL OR finish_reason = 'unknown' THEN 'uncertain' ELSE 'covered' END AS status FROM lp), ds AS (SELECT document_id, unnest(range(0, CAST(page_count AS BIGINT))) AS page_idx FROM (SELECT document_id, max(page_count) AS page_count FROM document_ir WHERE parser <> 'mineru' GROUP BY 1) WHERE page_count > 0), ws AS (SELECT document_id, page_idx, status, batch FROM cr QUALIFY row_number() OVER (PARTITION BY document_id, page_idx ORDER BY CASE status WHEN 'contradicted' THEN 3 WHEN 'uncertain' THEN 2 ELSE 1 END DESC, batch) = 1), mg AS (SELECT ds.document_id, ds.page_idx, coalesce(ws.status, 'omitted') AS status, ws.batch FROM ds LEFT JOIN ws USING (document_id, page_idx))"


def coverage(s, d):
    low = F.lower("finish_reason")
    status = F.when(low.rlike("len|max|error"), "contradicted").when(F.col("finish_reason").isNull() | (F.col("finish_reason") == "unknown"), "uncertain").otherwise("covered")
    rows = B.pages(s, d).select("document_id", F.col("page_idx").cast("long").alias("page_idx"), F.col("attempts").alias("batch"), status.alias("status"))
    claims = table(s, d, "document_ir").where("parser <> 'mineru'").groupBy("document_id").agg(F.max("page_count").alias("n")).where("n > 0").select("document_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n").cast("long") - 1)).alias("page_idx"))
    return versioning.worst_status(claims, rows, ["document_id", "page_idx"])


@query("q078_worst_status", f"WITH {_COV} SELECT document_id, page_idx, status, batch FROM mg")
def _(s, d):
    return coverage(s, d)


@query("q079_review_decision", f"WITH {_COV} SELECT document_id, count(*) AS claims, CASE WHEN bool_or(status = 'uncertain') THEN 'human_review' WHEN bool_or(status IN ('contradicted', 'omitted')) THEN 'recompile' ELSE 'pass' END AS decision FROM mg GROUP BY 1")
def _(s, d):
    return versioning.review_decision(coverage(s, d), "document_id")


@query("q090_first_last_audit", f"WITH {B.PAGES} SELECT document_id, page_idx, count(*) AS parses, arg_min(length(content), record_id) AS first_chars, arg_max(length(content), record_id) AS last_chars FROM lp WHERE content IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1")
def _(s, d):
    n = F.char_length("content").cast("long")
    return B.pages(s, d).where("content is not null").groupBy("document_id", "page_idx").agg(F.count("*").alias("parses"), F.min_by(n, "record_id").alias("first_chars"), F.max_by(n, "record_id").alias("last_chars")).where("parses > 1")


@query("q092_sentence_batches", rf"WITH {B.ATOMS}, se AS (SELECT article_id, pos, unnest(list_filter(list_transform(regexp_extract_all(text, '([^。！？!?；;]+[。！？!?；;]*)', 1), lambda x: trim(x)), lambda x: x <> '')) AS sentence, unnest(range(1, len(list_filter(list_transform(regexp_extract_all(text, '([^。！？!?；;]+[。！？!?；;]*)', 1), lambda x: trim(x)), lambda x: x <> '')) + 1)) AS i FROM atm WHERE block_type = 'text'), nb AS (SELECT article_id, length(sentence) AS n, (row_number() OVER (PARTITION BY article_id ORDER BY pos, i) - 1) // 8 AS batch FROM se) SELECT article_id, batch, count(*) AS sentences, CAST(sum(n) AS BIGINT) AS chars FROM nb GROUP BY 1, 2")
def _(s, d):
    parts = F.filter(F.transform(F.regexp_extract_all("text", F.lit("([^。！？!?；;]+[。！？!?；;]*)"), 1), lambda x: F.trim(x)), lambda x: x != "")
    se = B.atoms(s, d).where("block_type = 'text'").select("article_id", "pos", F.posexplode(parts).alias("i", "sentence"))
    n = F.row_number().over(W.partitionBy("article_id").orderBy("pos", "i")) - 1
    return se.withColumn("batch", F.floor(n / 8)).groupBy("article_id", "batch").agg(F.count("*").alias("sentences"), F.sum(F.char_length("sentence")).alias("chars"))


@query("q094_unique_slugs", f"WITH {B.CONCEPTS}, sl AS (SELECT filename, lower(regexp_replace(regexp_replace(trim(title), '[\\\\/:*?\"<>|#\\s]+', '-', 'g'), '^-+|-+$', '', 'g')) AS slug FROM lc WHERE title IS NOT NULL) SELECT filename, CASE WHEN n = 1 THEN slug ELSE slug || '-' || n END AS unique_slug FROM (SELECT filename, slug, row_number() OVER (PARTITION BY slug ORDER BY filename) AS n FROM sl)")
def _(s, d):
    sl = B.concepts(s, d).where("title is not null").select("filename", X.slug(F.col("title")).alias("slug"))
    n = F.row_number().over(W.partitionBy("slug").orderBy("filename"))
    return sl.withColumn("n", n).select("filename", F.when(F.col("n") == 1, F.col("slug")).otherwise(F.concat_ws("-", "slug", "n")).alias("unique_slug"))


@query("q099_index_order", f"WITH {B.CONCEPTS} SELECT filename, row_number() OVER (ORDER BY CASE concept_type WHEN 'Topic' THEN 1 WHEN 'Proposition' THEN 2 WHEN 'Method' THEN 3 ELSE 4 END, concept_type, title NULLS LAST, filename) AS place, row_number() OVER (PARTITION BY concept_type ORDER BY title NULLS LAST, filename) AS place_in_type FROM lc")
def _(s, d):
    c = B.concepts(s, d).withColumn("o", F.when(F.col("concept_type") == "Topic", 1).when(F.col("concept_type") == "Proposition", 2).when(F.col("concept_type") == "Method", 3).otherwise(4))
    inside = F.row_number().over(W.partitionBy("o", "concept_type").orderBy(F.asc_nulls_last("title"), "filename"))
    sizes = c.groupBy("o", "concept_type").agg(F.count("*").alias("n"))  # a row a type
    before = sizes.withColumn("before", F.coalesce(F.sum("n").over(W.orderBy("o", "concept_type").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).select("o", "concept_type", "before")
    return c.withColumn("r", inside).join(F.broadcast(before), ["o", "concept_type"]).select("filename", (F.col("before") + F.col("r")).alias("place"), F.col("r").cast("long").alias("place_in_type"))


@query("q104_document_jaccard", f"WITH {B.SEGMENTS}, w AS (SELECT DISTINCT document_id, ordinal, unnest({B.TOKENS.format('content')}) AS t FROM ls), n AS (SELECT document_id, ordinal, count(*) AS n FROM w GROUP BY 1, 2) SELECT a.document_id, a.ordinal, round(count(b.t) / (any_value(x.n) + any_value(y.n) - count(b.t)), 6) AS jaccard FROM w a JOIN n x ON x.document_id = a.document_id AND x.ordinal = a.ordinal JOIN n y ON y.document_id = a.document_id AND y.ordinal = a.ordinal + 1 LEFT JOIN w b ON b.document_id = a.document_id AND b.ordinal = a.ordinal + 1 AND b.t = a.t GROUP BY 1, 2")
def _(s, d):
    x = B.segments(s, d).select("document_id", "ordinal", F.array_distinct(X.tokens(F.col("content"))).alias("w"))
    nxt = x.select("document_id", (F.col("ordinal") - 1).alias("ordinal"), F.col("w").alias("v"))
    j = x.join(nxt, ["document_id", "ordinal"])
    return j.select("document_id", "ordinal", F.round(F.size(F.array_intersect("w", "v")) / F.size(F.array_union("w", "v")), 6).alias("jaccard"))


@query("q107_group_changes", f"WITH {B.CONCEPTS}, o AS (SELECT filename AS g, unnest(source_blocks) AS m FROM lc WHERE substr(sha256(filename), 1, 1) < 'c'), w AS (SELECT filename AS g, unnest(CASE WHEN substr(sha256(filename), 2, 1) < '8' THEN source_blocks[1:1] ELSE source_blocks END) AS m FROM lc WHERE substr(sha256(filename), 1, 1) >= '4'), a AS (SELECT g, string_agg(DISTINCT m, ',' ORDER BY m) AS s FROM o GROUP BY 1), b AS (SELECT g, string_agg(DISTINCT m, ',' ORDER BY m) AS s FROM w GROUP BY 1) SELECT coalesce(a.g, b.g) AS filename, CASE WHEN b.s IS NULL THEN 'retired' WHEN a.s = b.s THEN 'reused' ELSE 'affected' END AS state FROM a FULL JOIN b ON a.g = b.g")
def _(s, d):
    c = B.concepts(s, d).withColumn("h", F.sha2("filename", 256))
    old = c.where(F.substring("h", 1, 1) < "c").select("filename", F.explode("source_blocks").alias("m"))
    new = c.where(F.substring("h", 1, 1) >= "4").select("filename", F.explode(F.when(F.substring("h", 2, 1) < "8", F.slice("source_blocks", 1, 1)).otherwise(F.col("source_blocks"))).alias("m"))
    return versioning.group_changes(old, new, "filename", "m")


@query("q110_exact_duplicates", "SELECT sha256(text) AS hash, min(doc_id) AS first_key, count(*) AS copies FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def _(s, d):
    return records.duplicate_groups(table(s, d, "documents").where("text is not null"), "doc_id", F.col("text"))


@query("q118_paragraphs", f"WITH {B.SEGMENTS} SELECT segment_id, len(p) AS paragraphs, list_max(list_transform(p, lambda x: length(x))) AS longest FROM (SELECT segment_id, list_filter(string_split(content, chr(10) || chr(10)), lambda x: trim(x) <> '') AS p FROM ls) WHERE len(p) > 0")
def _(s, d):
    p = F.filter(F.split("content", "\n\n"), lambda x: F.trim(x) != "")
    x = B.segments(s, d).select("segment_id", p.alias("p")).where(F.size("p") > 0)
    return x.select("segment_id", F.size("p").cast("long").alias("paragraphs"), F.array_max(F.transform("p", lambda t: F.char_length(t))).cast("long").alias("longest"))


@query("q134_image_paths", f"WITH {B.CONCEPTS} SELECT filename, regexp_extract(body, '!\\[[^\\]]*\\]\\(([^)]*)\\)', 1) AS first_image, sha256(regexp_replace(body, '\\]\\(images/', '](../images/', 'g')) AS rewritten_hash FROM lc WHERE regexp_matches(body, '!\\[')")
def _(s, d):
    return B.concepts(s, d).where(F.col("body").rlike(r"!\[")).select("filename", F.regexp_extract("body", r"!\[[^\]]*\]\(([^)]*)\)", 1).alias("first_image"), F.sha2(F.regexp_replace("body", r"\]\(images/", "](../images/"), 256).alias("rewritten_hash"))


@query("q140_hard_anchors", f"WITH {B.ATOMS} SELECT atom_id, len(a) AS anchors, len(list_distinct(a)) AS distinct_anchors FROM (SELECT atom_id, regexp_extract_all(text, '(《[^》]+》|[0-9]{{4}}年|[0-9]+(?:[.,][0-9]+)*%?)', 1) AS a FROM atm) WHERE len(a) > 0")
def _(s, d):
    a = F.regexp_extract_all("text", F.lit(r"(《[^》]+》|[0-9]{4}年|[0-9]+(?:[.,][0-9]+)*%?)"), 1)
    x = B.atoms(s, d).select("atom_id", F.size(a).cast("long").alias("anchors"), F.size(X.hard_anchors(F.col("text"))).cast("long").alias("distinct_anchors"))
    return x.where("anchors > 0")


@query("q141_unsupported_anchors", f"WITH {B.ATOMS}, {B.CONCEPTS}, ev AS (SELECT filename, unnest(regexp_extract_all(text, '([0-9]+(?:[.,][0-9]+)*%?)', 1)) AS a FROM (SELECT filename, unnest(list_distinct(source_blocks)) AS block_id FROM lc) JOIN atm USING (block_id)), cl AS (SELECT DISTINCT filename, unnest(regexp_extract_all(body, '([0-9]+(?:[.,][0-9]+)*%?)', 1)) AS a FROM lc) SELECT filename, count(*) AS anchors, count(*) FILTER (WHERE (filename, a) NOT IN (SELECT filename, a FROM ev)) AS unsupported FROM cl GROUP BY 1")
def _(s, d):
    num = lambda c: F.explode(F.array_distinct(F.regexp_extract_all(c, F.lit(r"([0-9]+(?:[.,][0-9]+)*%?)"), 1))).alias("a")
    c = B.concepts(s, d)
    ev = c.select("filename", F.explode(F.array_distinct("source_blocks")).alias("block_id")).join(B.atoms(s, d).select("block_id", "text"), "block_id").select("filename", num("text")).distinct().withColumn("ok", F.lit(1))
    return c.select("filename", num("body")).join(ev, ["filename", "a"], "left").groupBy("filename").agg(F.count("*").alias("anchors"), F.count_if(F.col("ok").isNull()).alias("unsupported"))


@query("q149_scope_relations", f"""WITH {_EDGES}, y AS (SELECT filename, list_transform(regexp_extract_all(regexp_replace(regexp_replace(body, '([0-9])([\\x{{3400}}-\\x{{9fff}}])', '\\1x\\2', 'g'), '([\\x{{3400}}-\\x{{9fff}}])([0-9])', '\\1x\\2', 'g'), '\\b(19[0-9]{{2}}|20[0-9]{{2}})\\b', 1), lambda v: CAST(v AS INT)) AS ys, concept_type AS place FROM lc) SELECT left_ref, right_ref, CASE WHEN len(a.ys) = 0 AND a.place IS NULL OR len(b.ys) = 0 AND b.place IS NULL THEN 'unknown' WHEN len(a.ys) > 0 AND len(b.ys) > 0 AND NOT (list_min(a.ys) <= list_max(b.ys) AND list_min(b.ys) <= list_max(a.ys)) THEN 'temporal_variant' WHEN a.place <> b.place THEN 'scenario_variant' WHEN len(a.ys) > 0 AND len(b.ys) > 0 AND a.place = b.place THEN 'same' ELSE 'overlap' END AS relation FROM ed JOIN y a ON a.filename = left_ref JOIN y b ON b.filename = right_ref""")
def _(s, d):
    y = B.concepts(s, d).select("filename", X.year_interval(F.col("body")).alias("t"), F.array("concept_type").alias("p"))
    e = resolve.candidate_edges(refs(s, d)).select("left_ref", "right_ref")
    j = e.join(y.select(F.col("filename").alias("left_ref"), F.col("t").alias("lt"), F.col("p").alias("lp")), "left_ref").join(y.select(F.col("filename").alias("right_ref"), F.col("t").alias("rt"), F.col("p").alias("rp")), "right_ref")
    return j.select("left_ref", "right_ref", versioning.scope_relation(F.col("lt"), F.col("rt"), F.col("lp"), F.col("rp")).alias("relation"))


@query("q151_stable_ids", f"WITH {B.BLOCKS} SELECT block_id, 'blk-' || substr(sha256(document_id || chr(31) || block_id || chr(31) || block_type), 1, 16) AS stable_id FROM lb")
def _(s, d):
    return B.blocks(s, d).select("block_id", X.stable_id("blk", F.col("document_id"), F.col("block_id"), F.col("block_type")).alias("stable_id"))


@query("q152_atom_ids", r"SELECT DISTINCT atom_id, regexp_extract(atom_id, '^(.*):p([0-9]+):([sb])(.*)$', 1) AS article_id, CAST(nullif(regexp_extract(atom_id, '^(.*):p([0-9]+):([sb])(.*)$', 2), '') AS INT) AS page, regexp_extract(atom_id, '^(.*):p([0-9]+):([sb])(.*)$', 4) AS locator FROM evidence_atoms")
def _(s, d):
    p = r"^(.*):p([0-9]+):([sb])(.*)$"
    x = table(s, d, "evidence_atoms").select("atom_id").distinct()
    return x.select("atom_id", F.regexp_extract("atom_id", p, 1).alias("article_id"), F.nullif(F.regexp_extract("atom_id", p, 2), F.lit("")).cast("int").alias("page"), F.regexp_extract("atom_id", p, 4).alias("locator"))


@query("q157_location_labels", f"WITH {B.ATOMS} SELECT atom_id, CASE WHEN coalesce(len(heading_path), 0) > 0 THEN array_to_string(heading_path, ' › ') || ' · ' ELSE '' END || 'p. ' || page AS label FROM atm")
def _(s, d):
    path = F.when(F.coalesce(F.size("heading_path"), F.lit(0)) > 0, F.concat(F.array_join("heading_path", " › "), F.lit(" · "))).otherwise("")
    return B.atoms(s, d).select("atom_id", F.concat(path, F.lit("p. "), F.col("page").cast("string")).alias("label"))


@query("q199_provenance_trace", f"WITH {B.CONCEPTS}, {B.BLOCKS}, {B.DOCUMENTS_IR} SELECT filename, block_id, lb.document_id, ld.source_file, lb.page_idx FROM (SELECT filename, unnest(list_distinct(source_blocks)) AS block_id FROM lc) JOIN lb USING (block_id) LEFT JOIN ld ON ld.document_id = lb.document_id")
def _(s, d):
    r = B.concepts(s, d).select("filename", F.explode(F.array_distinct("source_blocks")).alias("block_id")).join(B.blocks(s, d).select("block_id", "document_id", "page_idx"), "block_id")
    return r.join(B.documents_ir(s, d).select("document_id", "source_file"), "document_id", "left").select("filename", "block_id", "document_id", "source_file", "page_idx")


@query("q199_order_trace", "SELECT r_name, n_name, count(DISTINCT c_custkey) AS customers, count(o_orderkey) AS orders, round(sum(o_totalprice), 2) AS value FROM region JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2")
def _(s, d):
    n = table(s, d, "region").join(table(s, d, "nation"), F.col("n_regionkey") == F.col("r_regionkey")).select("r_name", "n_name", "n_nationkey")
    c = table(s, d, "customer").select("c_custkey", "c_nationkey").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    o = table(s, d, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_totalprice")
    return c.join(o, "c_custkey", "left").groupBy("r_name", "n_name").agg(F.count_distinct("c_custkey").alias("customers"), F.count("o_orderkey").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("value"))


@query("q200_reconcile", f"WITH {B.PAGES}, k AS (SELECT document_id, content, row_number() OVER (PARTITION BY document_id, page_idx ORDER BY record_id) AS n FROM lp WHERE content IS NOT NULL), o AS (SELECT document_id, content, row_number() OVER (PARTITION BY document_id, content) AS n FROM k WHERE n = 1), w AS (SELECT document_id, content, row_number() OVER (PARTITION BY document_id, content) AS n FROM k WHERE n > 1), b AS (SELECT coalesce(o.document_id, w.document_id) AS document_id, o.document_id IS NOT NULL AS a, w.document_id IS NOT NULL AS c FROM o FULL JOIN w ON o.document_id = w.document_id AND o.content = w.content AND o.n = w.n), t AS (SELECT document_id, count(*) FILTER (WHERE a AND c) AS same, count(*) FILTER (WHERE a AND NOT c) AS old_only, count(*) FILTER (WHERE c AND NOT a) AS new_only FROM b GROUP BY 1) SELECT document_id, same AS unchanged, least(old_only, new_only) AS revised, greatest(new_only - old_only, 0) AS added, greatest(old_only - new_only, 0) AS not_repeated FROM t")
def _(s, d):
    k = B.pages(s, d).where("content is not null").withColumn("n", F.row_number().over(W.partitionBy("document_id", "page_idx").orderBy("record_id"))).select("document_id", F.sha2("content", 256).alias("content"), "n")
    r = versioning.reconcile(k.where("n = 1").select("document_id", "content"), k.where("n > 1").select("document_id", "content"), "document_id", "content")
    return r.groupBy("document_id").agg(*[F.count_if(F.col("status") == x).alias(x) for x in ("unchanged", "revised", "added", "not_repeated")])


@query("q203_needs_compile", f"WITH {B.BLOCKS}, f AS (SELECT document_id, sha256(string_agg(block_id || ':' || coalesce(content, ''), chr(30) ORDER BY block_id)) AS fp FROM lb GROUP BY 1) SELECT document_id, CASE WHEN h < '4' THEN 'new' WHEN h < '8' THEN 'changed' WHEN h < 'c' THEN 'incomplete' ELSE 'reuse' END AS action, fp AS fingerprint FROM (SELECT *, substr(sha256(document_id), 1, 1) AS h FROM f)")
def _(s, d):
    f = B.blocks(s, d).groupBy("document_id").agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat(F.col("block_id"), F.lit(":"), F.coalesce("content", F.lit(""))))), "\x1e"), 256).alias("fingerprint"))
    f = f.withColumn("h", F.substring(F.sha2("document_id", 256), 1, 1))
    state = f.where("h >= '4'").select("document_id", F.when(F.col("h") < "8", F.lit("old")).otherwise(F.col("fingerprint")).alias("fingerprint"), (F.col("h") >= "c").alias("complete"))
    return records.needs_compile(f, state, "document_id").select("document_id", "action", "fingerprint")


_RULES = {"private_host": r"https?://(?:localhost|127\.0\.0\.1|10\.[0-9.]+|192\.168\.[0-9.]+)", "email": r"[A-Za-z0-9._+-]+@[A-Za-z0-9-]+\.[A-Za-z.]+", "url": r"https?://[A-Za-z0-9.-]+", "long_hex": r"\b[0-9a-f]{64}\b"}


@query("q217_leak_scan", "WITH h AS (" + " UNION ALL ".join(f"SELECT doc_id, '{k}' AS rule, len(regexp_extract_all(text, '{v}')) AS hits FROM documents" for k, v in _RULES.items()) + ") SELECT doc_id, rule, CAST(hits AS INT) AS hits FROM h WHERE hits > 0")
def _(s, d):
    return records.leak_scan(table(s, d, "documents"), "doc_id", "text", _RULES)


@query("x1_rollup", "SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n, round(sum(value), 3) AS total FROM events GROUP BY ROLLUP (event_type, CAST(ts AS DATE))")
def _(s, d):
    return table(s, d, "events").withColumn("day", F.to_date("ts")).rollup("event_type", "day").agg(F.count("*").alias("n"), F.round(F.sum("value"), 3).alias("total"))


@query("x2_sessions", "WITH g AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS c FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), n AS (SELECT user_id, ts, sum(c) OVER (PARTITION BY user_id ORDER BY ts RANGE UNBOUNDED PRECEDING) AS k FROM g) SELECT user_id, min(ts) AS started, count(*) AS events FROM n GROUP BY user_id, k")
def _(s, d):
    e = table(s, d, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    x = e.groupBy("user_id", F.session_window("ts", "30 minutes").alias("w")).agg(F.count("*").alias("events"))
    return x.select("user_id", F.col("w.start").cast("timestamp_ntz").alias("started"), "events")


@query("x3_tumbling", "SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS hour, count(*) AS n FROM events GROUP BY 1, 2")
def _(s, d):
    return table(s, d, "events").groupBy("event_type", F.date_trunc("hour", F.col("ts").cast("timestamp")).cast("timestamp_ntz").alias("hour")).agg(F.count("*").alias("n"))


@query("x4_as_of", "WITH o AS (SELECT o_orderkey, o_custkey, o_orderdate FROM orders) SELECT o_orderkey, max(prev) AS previous_order FROM (SELECT o_orderkey, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev FROM o) GROUP BY 1")
def _(s, d):
    o = table(s, d, "orders")
    return o.select("o_orderkey", F.lag("o_orderkey").over(W.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")).alias("previous_order"))
