"""Queries on evidence, anchors, assets, indexes and logs."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkwell.functions import text as X
from inkwell.operators import resolve, retrieval, structure, units, versioning
from inkwell.plans import base as B
from inkwell.plans.knowledge_queries import _EDGES, refs
from inkwell.session import checkpoint, table

Q: dict[str, tuple] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        Q[name] = (f, sql)
        return f

    return add


@query("q041_related_edges", f"WITH {_EDGES} SELECT least(a.article_id, b.article_id) AS article_a, greatest(a.article_id, b.article_id) AS article_b, count(*) AS relations, round(max(score), 6) AS strongest FROM ed JOIN rf a ON a.ref_id = left_ref JOIN rf b ON b.ref_id = right_ref WHERE score < 0.5 GROUP BY 1, 2")
def _(s, d):
    r = refs(s, d).select("ref_id", "article_id")
    e = resolve.candidate_edges(refs(s, d)).where("score < 0.5")
    j = e.join(r.select(F.col("ref_id").alias("left_ref"), F.col("article_id").alias("a")), "left_ref").join(r.select(F.col("ref_id").alias("right_ref"), F.col("article_id").alias("b")), "right_ref")
    return j.groupBy(F.least("a", "b").alias("article_a"), F.greatest("a", "b").alias("article_b")).agg(F.count("*").alias("relations"), F.round(F.max("score"), 6).alias("strongest"))


@query("q057_trace_catalog", f"WITH {B.ATOMS} SELECT count(*) AS trace_rows, count(atm.atom_id) AS known, count(*) FILTER (WHERE atm.atom_id IS NULL) AS unknown FROM (SELECT DISTINCT article_id, block_id FROM evidence_atoms) e LEFT JOIN atm USING (article_id, block_id)")
def _(s, d):
    e = table(s, d, "evidence_atoms").select("article_id", "block_id").distinct()
    j = e.join(B.atoms(s, d).select("article_id", "block_id", F.lit(1).alias("hit")), ["article_id", "block_id"], "left")
    return j.agg(F.count("*").alias("trace_rows"), F.count("hit").alias("known"), F.count_if(F.col("hit").isNull()).alias("unknown"))


@query("q064_log_fields", "WITH p AS (SELECT event_type, user_id, ts, CAST(nullif(regexp_extract(props, '\"k\": *([0-9]+)', 1), '') AS BIGINT) AS k FROM events) SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, count(k) AS parsed, CAST(sum(k) AS BIGINT) AS total, round(avg(k), 4) AS mean, max(k) AS most, min(ts) AS first_ts, max(ts) AS last_ts FROM p GROUP BY 1")
def _(s, d):
    """A field parsed out of each log line, summed by event type; lines without it count as unparsed."""
    k = F.nullif(F.regexp_extract("props", r'"k": *([0-9]+)', 1), F.lit("")).cast("long")
    e = table(s, d, "events").withColumn("k", k)
    return e.groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"), F.count("k").alias("parsed"), F.sum("k").alias("total"), F.round(F.avg("k"), 4).alias("mean"), F.max("k").alias("most"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@query("q100_candidate_sections", f"WITH {B.CONCEPTS}, {B.BLOCKS}, {B.SEGMENTS}, ct AS (SELECT filename, unnest(list_distinct({B.TOKENS.format('title')})) AS t FROM lc WHERE title IS NOT NULL), cd AS (SELECT DISTINCT filename, document_id FROM (SELECT filename, unnest(source_blocks) AS block_id FROM lc) JOIN lb USING (block_id)), st AS (SELECT document_id, segment_id, unnest(list_distinct({B.TOKENS.format('content')})) AS t FROM ls), sc AS (SELECT filename, segment_id, count(*) AS overlap FROM ct JOIN cd USING (filename) JOIN st USING (document_id, t) GROUP BY 1, 2) SELECT filename, segment_id, overlap, row_number() OVER (PARTITION BY filename ORDER BY overlap DESC, segment_id) AS rank FROM sc QUALIFY rank <= 4")
def _(s, d):
    c = B.concepts(s, d)
    ct = c.where("title is not null").select("filename", F.explode(F.array_distinct(X.tokens(F.col("title")))).alias("t"))
    cd = c.select("filename", F.explode("source_blocks").alias("block_id")).join(B.blocks(s, d).select("block_id", "document_id"), "block_id").select("filename", "document_id").distinct()
    st = B.segments(s, d).select("document_id", "segment_id", F.explode(F.array_distinct(X.tokens(F.col("content")))).alias("t"))
    sc = ct.join(cd, "filename").join(st, ["document_id", "t"]).groupBy("filename", "segment_id").agg(F.count("*").alias("overlap"))
    k = F.row_number().over(W.partitionBy("filename").orderBy(F.desc("overlap"), "segment_id"))
    return sc.withColumn("rank", k).where("rank <= 4").select("filename", "segment_id", "overlap", F.col("rank").cast("long"))


@query("q101_newest_records", f"WITH {B.PAGES} SELECT record_id, recorded_at FROM lp ORDER BY recorded_at DESC NULLS LAST, record_id LIMIT 200")
def _(s, d):
    return B.pages(s, d).orderBy(F.desc_nulls_last("recorded_at"), "record_id").limit(200).select("record_id", "recorded_at")


@query("q102_content_tails", f"WITH {B.PAGES} SELECT record_id, right(content, 80) AS tail, length(content) AS chars FROM lp WHERE content IS NOT NULL")
def _(s, d):
    return B.pages(s, d).where("content is not null").select("record_id", F.right("content", F.lit(80)).alias("tail"), F.char_length("content").cast("long").alias("chars"))


@query("q115_heading_tokens", f"WITH {B.BLOCKS}, h AS (SELECT block_id, content AS c FROM lb WHERE block_type = 'title' AND content IS NOT NULL), t AS (SELECT block_id, lower(unnest(regexp_extract_all(c, '[A-Za-z0-9]+'))) AS token FROM h UNION SELECT block_id, substr(z, i, 2) FROM (SELECT block_id, z, unnest(range(1, length(z))) AS i FROM (SELECT block_id, regexp_replace(c, '[^\\x{{3400}}-\\x{{9fff}}]', '', 'g') AS z FROM h) WHERE length(z) > 1)) SELECT block_id, count(DISTINCT token) AS tokens, min(token) AS first_token FROM t GROUP BY 1")
def _(s, d):
    h = B.blocks(s, d).where("block_type = 'title' and content is not null").select("block_id", F.col("content").alias("c"))
    words = F.transform(F.regexp_extract_all("c", F.lit("([A-Za-z0-9]+)"), 1), F.lower)
    han = F.regexp_replace("c", r"[^\x{3400}-\x{9fff}]", "")
    grams = F.when(F.char_length(han) > 1, F.transform(F.sequence(F.lit(1), F.char_length(han) - 1), lambda i: han.substr(i, F.lit(2)))).otherwise(F.expr("cast(array() as array<string>)"))
    x = h.select("block_id", F.array_distinct(F.concat(words, grams)).alias("t")).where(F.size("t") > 0)
    return x.select("block_id", F.size("t").cast("long").alias("tokens"), F.array_min("t").alias("first_token"))


@query("q121_inferred_levels", f"WITH {B.POSITIONED}, h AS (SELECT document_id, block_id, pos, CASE WHEN heading_level BETWEEN 1 AND 6 THEN heading_level END AS declared FROM pb WHERE block_type = 'title') SELECT block_id, coalesce(declared, last_value(declared IGNORE NULLS) OVER (PARTITION BY document_id ORDER BY pos ROWS UNBOUNDED PRECEDING), 1) AS level, CASE WHEN declared IS NOT NULL THEN 'declared' WHEN last_value(declared IGNORE NULLS) OVER (PARTITION BY document_id ORDER BY pos ROWS UNBOUNDED PRECEDING) IS NOT NULL THEN 'previous' ELSE 'default' END AS level_source FROM h")
def _(s, d):
    h = structure.positioned(B.blocks(s, d)).where("block_type = 'title'").withColumn("declared", F.when(F.col("heading_level").between(1, 6), F.col("heading_level")))
    before = F.last("declared", ignorenulls=True).over(W.partitionBy("document_id").orderBy("pos").rowsBetween(W.unboundedPreceding, W.currentRow))
    return h.withColumn("b", before).select("block_id", F.coalesce("declared", "b", F.lit(1)).alias("level"), F.when(F.col("declared").isNotNull(), "declared").when(F.col("b").isNotNull(), "previous").otherwise("default").alias("level_source"))


@query("q135_asset_anchors", f"WITH {B.POSITIONED}, un AS (SELECT *, count(*) OVER (PARTITION BY document_id, trim(content)) AS same FROM pb), a AS (SELECT block_id, block_type, last_value(CASE WHEN block_type = 'text' AND same = 1 AND trim(content) <> '' THEN block_id END IGNORE NULLS) OVER (PARTITION BY document_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before, first_value(CASE WHEN block_type = 'text' AND same = 1 AND trim(content) <> '' THEN block_id END IGNORE NULLS) OVER (PARTITION BY document_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next FROM un) SELECT block_id AS asset_id, coalesce(before, next) AS anchor, CASE WHEN before IS NOT NULL THEN 'after' WHEN next IS NOT NULL THEN 'before' ELSE 'unplaced' END AS place FROM a WHERE block_type IN ('image', 'table')")
def _(s, d):
    """Each asset goes behind the last text before it whose words are unique in the document, else before the next such text."""
    b = structure.positioned(B.blocks(s, d)).withColumn("same", F.count("*").over(W.partitionBy("document_id", F.trim("content"))))
    unique = F.when((F.col("block_type") == "text") & (F.col("same") == 1) & (F.trim("content") != ""), F.col("block_id"))
    w = W.partitionBy("document_id").orderBy("pos")
    a = b.select("block_id", "block_type", F.last(unique, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, -1)).alias("before"), F.first(unique, ignorenulls=True).over(w.rowsBetween(1, W.unboundedFollowing)).alias("next"))
    place = F.when(F.col("before").isNotNull(), "after").when(F.col("next").isNotNull(), "before").otherwise("unplaced")
    return a.where("block_type in ('image', 'table')").select(F.col("block_id").alias("asset_id"), F.coalesce("before", "next").alias("anchor"), place.alias("place"))


@query("q137_asset_routes", f"""WITH {B.CONCEPTS}, {B.BLOCKS}, e AS (SELECT DISTINCT filename, unnest(source_blocks) AS block_id FROM lc), r AS (SELECT block_id, count(*) AS k, min(filename) AS f FROM e GROUP BY 1), eb AS (SELECT e.filename, lb.document_id, array_to_string(lb.heading_path, '>') AS path FROM e JOIN lb USING (block_id)),
 dr AS (SELECT document_id, count(DISTINCT filename) AS k, min(filename) AS f FROM eb GROUP BY 1), hr AS (SELECT document_id, path, count(DISTINCT filename) AS k, min(filename) AS f FROM eb WHERE path IS NOT NULL GROUP BY 1, 2)
 SELECT lb.block_id AS asset_id, CASE WHEN r.k = 1 THEN r.f WHEN r.k > 1 THEN NULL WHEN dr.k = 1 THEN dr.f WHEN hr.k = 1 THEN hr.f END AS concept, CASE WHEN r.k = 1 THEN 'hint' WHEN r.k > 1 THEN 'ambiguous' WHEN dr.k = 1 THEN 'single_group' WHEN hr.k = 1 THEN 'section' WHEN dr.k > 1 THEN 'ambiguous' ELSE 'unresolved' END AS route
 FROM lb LEFT JOIN r USING (block_id) LEFT JOIN dr USING (document_id) LEFT JOIN hr ON hr.document_id = lb.document_id AND hr.path = array_to_string(lb.heading_path, '>') WHERE block_type IN ('image', 'table')""")
def _(s, d):
    """A unique hint wins, then the document's only concept, then the only one of the asset's own section; a tie is no route."""
    b = B.blocks(s, d).select("block_id", "document_id", "block_type", F.array_join("heading_path", ">").alias("path"))
    e = B.concepts(s, d).select("filename", F.explode("source_blocks").alias("block_id")).distinct()
    r = e.groupBy("block_id").agg(F.count("*").alias("k"), F.min("filename").alias("f"))
    eb = e.join(b, "block_id")
    dr = eb.groupBy("document_id").agg(F.count_distinct("filename").alias("dk"), F.min("filename").alias("df"))
    hr = eb.where("path is not null").groupBy("document_id", "path").agg(F.count_distinct("filename").alias("hk"), F.min("filename").alias("hf"))
    j = b.where("block_type in ('image', 'table')").join(r, "block_id", "left").join(dr, "document_id", "left").join(hr, ["document_id", "path"], "left")
    one = lambda c: F.coalesce(F.col(c) == 1, F.lit(False))
    many = F.coalesce(F.col("k") > 1, F.lit(False))
    concept = F.when(one("k"), F.col("f")).when(many, F.lit(None)).when(one("dk"), F.col("df")).when(one("hk"), F.col("hf"))
    route = F.when(one("k"), "hint").when(many, "ambiguous").when(one("dk"), "single_group").when(one("hk"), "section").when(F.col("dk") > 1, "ambiguous").otherwise("unresolved")
    return j.select(F.col("block_id").alias("asset_id"), concept.alias("concept"), route.alias("route"))


@query("q142_unsupported_years", f"WITH {B.ATOMS}, {B.CONCEPTS}, ev AS (SELECT DISTINCT filename, unnest(regexp_extract_all(text, '(?:19|20)[0-9]{{2}}')) AS y FROM (SELECT filename, unnest(list_distinct(source_blocks)) AS block_id FROM lc) JOIN atm USING (block_id)), cl AS (SELECT DISTINCT filename, unnest(regexp_extract_all(body, '(?:19|20)[0-9]{{2}}')) AS y FROM lc) SELECT filename, y AS year FROM cl WHERE (filename, y) NOT IN (SELECT filename, y FROM ev)")
def _(s, d):
    years = lambda c: F.explode(F.array_distinct(F.regexp_extract_all(c, F.lit("((?:19|20)[0-9]{2})"), 1))).alias("year")
    c = B.concepts(s, d)
    ev = c.select("filename", F.explode(F.array_distinct("source_blocks")).alias("block_id")).join(B.atoms(s, d).select("block_id", "text"), "block_id").select("filename", years("text")).distinct()
    return c.select("filename", years("body")).join(ev, ["filename", "year"], "left_anti")


_STRONG = "caused|proved|guarantee|导致|证明|prouvé|demostr|bewies"


@query("q143_inference_wording", f"WITH {B.ATOMS}, {B.CONCEPTS}, cl AS (SELECT DISTINCT filename, unnest(regexp_extract_all(body, '{_STRONG}')) AS phrase FROM lc), ev AS (SELECT DISTINCT filename, unnest(regexp_extract_all(text, '{_STRONG}')) AS phrase FROM (SELECT filename, unnest(list_distinct(source_blocks)) AS block_id FROM lc) JOIN atm USING (block_id)) SELECT cl.phrase, count(*) AS concepts, count(*) FILTER (WHERE ev.phrase IS NULL) AS unsupported FROM cl LEFT JOIN ev USING (filename, phrase) GROUP BY 1")
def _(s, d):
    hits = lambda c: F.explode(F.array_distinct(F.regexp_extract_all(c, F.lit(f"({_STRONG})"), 1))).alias("phrase")
    c = B.concepts(s, d)
    ev = c.select("filename", F.explode(F.array_distinct("source_blocks")).alias("block_id")).join(B.atoms(s, d).select("block_id", "text"), "block_id").select("filename", hits("text")).distinct().withColumn("ok", F.lit(1))
    return c.select("filename", hits("body")).join(ev, ["filename", "phrase"], "left").groupBy("phrase").agg(F.count("*").alias("concepts"), F.count_if(F.col("ok").isNull()).alias("unsupported"))


_BARE = r"[ \t\n\r\f.,;:!?。，；：！？、“”\"()（）-]"


@query("q144_canonical_excerpts", f"WITH {B.BLOCKS} SELECT f.fragment_id, b.content IS NOT NULL AND contains(regexp_replace(b.content, '{_BARE}', '', 'g'), regexp_replace(f.text, '{_BARE}', '', 'g')) AS located FROM (SELECT DISTINCT fragment_id, block_id, text FROM excluded_fragments WHERE text IS NOT NULL) f LEFT JOIN lb b ON f.block_id = b.block_id")
def _(s, d):
    bare = lambda c: F.regexp_replace(c, _BARE, "")
    f = table(s, d, "excluded_fragments").where("text is not null").select("fragment_id", "block_id", "text").distinct()
    j = f.join(B.blocks(s, d).select("block_id", "content"), "block_id", "left")
    return j.select("fragment_id", F.coalesce(bare(F.col("content")).contains(bare(F.col("text"))), F.lit(False)).alias("located"))


@query("q155_kinds", f"WITH {B.CONCEPTS} SELECT CASE lower(concept_type) WHEN 'topic' THEN 'Topic' WHEN 'proposition' THEN 'Proposition' WHEN 'method' THEN 'Topic' WHEN 'entity' THEN 'Entity' ELSE 'Evidence' END AS kind, count(*) AS concepts FROM lc GROUP BY 1")
def _(s, d):
    t = F.lower("concept_type")
    kind = F.when(t.isin("topic", "method"), "Topic").when(t == "proposition", "Proposition").when(t == "entity", "Entity").otherwise("Evidence")
    return B.concepts(s, d).groupBy(kind.alias("kind")).agg(F.count("*").alias("concepts"))


@query("q161_micro_units", f"WITH {B.CONCEPTS} SELECT filename AS unit_id, length(body) AS chars, array_to_string(list_sort(list_distinct(source_blocks)), '|') AS block_ids FROM lc")
def _(s, d):
    return B.concepts(s, d).select(F.col("filename").alias("unit_id"), F.char_length("body").cast("long").alias("chars"), F.array_join(F.array_sort(F.array_distinct("source_blocks")), "|").alias("block_ids"))


@query("q169_index_fingerprint", f"WITH RECURSIVE {B.T0} SELECT article_id, sha256(string_agg(unit_id || ':' || sha256(retrieval_text), chr(10) ORDER BY unit_id)) AS fingerprint, count(*) AS units FROM t0 GROUP BY 1")
def _(s, d):
    u = units.fixed_chunks(B.atoms(s, d)).select("article_id", F.concat_ws(":", "unit_id", F.sha2("retrieval_text", 256)).alias("x"))
    return u.groupBy("article_id").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("x")), "\n"), 256).alias("fingerprint"), F.count("*").alias("units"))


@query("q176_expanded_questions", f"WITH RECURSIVE {B.T0}, {B.CONCEPTS}, qu AS (SELECT filename AS question_id, title || chr(10) || chr(10) || concept_type AS question FROM lc WHERE title IS NOT NULL), {B.BM25} SELECT question_id, unit_id, rank FROM (SELECT question_id, unit_id, row_number() OVER (PARTITION BY question_id ORDER BY round(score, 9) DESC, unit_id) AS rank FROM bm) WHERE rank <= 10")
def _(s, d):
    q = B.concepts(s, d).where("title is not null").select(F.col("filename").alias("question_id"), F.concat("title", F.lit("\n\n"), "concept_type").alias("question"))
    index = checkpoint(retrieval.chunk_blocks(B.atoms(s, d)))
    return retrieval.top_k(retrieval.bm25_top_k_of_blocks(index, q, 10), 10).select("question_id", "unit_id", F.col("rank").cast("long"))


@query("q195_group_hashes", f"WITH RECURSIVE {_EDGES}, un AS (SELECT left_ref AS a, right_ref AS b FROM ed UNION SELECT right_ref, left_ref FROM ed), rc AS (SELECT a AS node, a AS reach FROM un UNION SELECT rc.node, un.b FROM rc JOIN un ON rc.reach = un.a), co AS (SELECT node, min(reach) AS component FROM rc GROUP BY 1) SELECT component, count(*) AS members, sha256(string_agg(node, chr(0) ORDER BY node)) AS group_hash FROM co GROUP BY 1")
def _(s, d):
    c = resolve.components(resolve.candidate_edges(refs(s, d)))
    return c.groupBy("component").agg(F.count("*").alias("members"), F.sha2(F.array_join(F.array_sort(F.collect_list("node")), "\0"), 256).alias("group_hash"))


@query("q198_provenance_graph", f"WITH {B.CONCEPTS}, {B.BLOCKS}, e AS (SELECT DISTINCT filename, block_id, document_id FROM (SELECT filename, unnest(source_blocks) AS block_id FROM lc) JOIN lb USING (block_id)) SELECT 'concept' AS kind, filename AS node, count(DISTINCT block_id) AS degree FROM e GROUP BY 2 UNION ALL SELECT 'article', document_id, count(DISTINCT filename) FROM e GROUP BY 2")
def _(s, d):
    e = B.concepts(s, d).select("filename", F.explode("source_blocks").alias("block_id")).join(B.blocks(s, d).select("block_id", "document_id"), "block_id").distinct()
    c = e.groupBy("filename").agg(F.count_distinct("block_id").alias("degree")).select(F.lit("concept").alias("kind"), F.col("filename").alias("node"), "degree")
    return c.unionByName(e.groupBy("document_id").agg(F.count_distinct("filename").alias("degree")).select(F.lit("article").alias("kind"), F.col("document_id").alias("node"), "degree"))


@query("q207_publish_split", f"WITH {B.CONCEPTS} SELECT concept_type, count(*) FILTER (WHERE title IS NOT NULL AND frontmatter IS NOT NULL AND coalesce(len(source_blocks), 0) > 0) AS publishable, count(*) FILTER (WHERE NOT (title IS NOT NULL AND frontmatter IS NOT NULL AND coalesce(len(source_blocks), 0) > 0)) AS needs_review FROM lc GROUP BY 1")
def _(s, d):
    ok = F.col("title").isNotNull() & F.col("frontmatter").isNotNull() & (F.coalesce(F.size("source_blocks"), F.lit(0)) > 0)
    return B.concepts(s, d).groupBy("concept_type").agg(F.count_if(ok).alias("publishable"), F.count_if(~ok).alias("needs_review"))


@query("q208_evidence_bundles", f"WITH {B.CONCEPTS}, x AS (SELECT block_id, count(DISTINCT fragment_id) AS excluded FROM excluded_fragments WHERE block_id IS NOT NULL GROUP BY 1), r AS (SELECT filename, unnest(list_distinct(source_blocks)) AS block_id FROM lc) SELECT filename, count(*) AS blocks, CAST(coalesce(sum(excluded), 0) AS BIGINT) AS excluded, 'eu-' || substr(sha256(filename || chr(31) || string_agg(block_id, ',' ORDER BY block_id)), 1, 12) AS bundle_id FROM r LEFT JOIN x USING (block_id) GROUP BY 1")
def _(s, d):
    x = table(s, d, "excluded_fragments").where("block_id is not null").groupBy("block_id").agg(F.count_distinct("fragment_id").alias("excluded"))
    r = B.concepts(s, d).select("filename", F.explode(F.array_distinct("source_blocks")).alias("block_id")).join(x, "block_id", "left")
    g = r.groupBy("filename").agg(F.count("*").alias("blocks"), F.coalesce(F.sum("excluded"), F.lit(0)).alias("excluded"), F.array_join(F.array_sort(F.collect_list("block_id")), ",").alias("b"))
    return g.select("filename", "blocks", "excluded", X.stable_id("eu", F.col("filename"), F.col("b"), length=12).alias("bundle_id"))


@query("q074_update_counts", f"WITH {B.CONCEPTS}, v AS (SELECT filename, compiled_at, sha256(coalesce(body, '')) AS h, row_number() OVER (PARTITION BY filename ORDER BY compiled_at) AS n, count(*) OVER (PARTITION BY filename) AS k FROM concept_documents), o AS (SELECT filename, h FROM v WHERE n = 1), w AS (SELECT filename, h FROM v WHERE n = k AND k > 1) SELECT CASE WHEN w.filename IS NULL THEN 'not_repeated' WHEN o.h = w.h THEN 'unchanged' ELSE 'revised' END AS status, count(*) AS refs FROM o LEFT JOIN w USING (filename) GROUP BY 1")
def _(s, d):
    v = table(s, d, "concept_documents").select("filename", "compiled_at", F.sha2(F.coalesce("body", F.lit("")), 256).alias("h"))
    v = v.withColumn("n", F.row_number().over(W.partitionBy("filename").orderBy("compiled_at"))).withColumn("k", F.count("*").over(W.partitionBy("filename")))
    r = versioning.reconcile(v.where("n = 1"), v.where("n = k and k > 1"), "filename", "h")
    return r.groupBy("status").agg(F.count("*").alias("refs"))
