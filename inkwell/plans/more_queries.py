"""Further queries: catalogs, overlays, samples, answers, links, set operations."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkwell.functions import text as X
from inkwell.operators import claims, records, resolve, structure, units
from inkwell.plans import base as B
from inkwell.plans.knowledge_queries import _EDGES, refs
from inkwell.session import table

Q: dict[str, tuple] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        Q[name] = (f, sql)
        return f

    return add


@query("q032_contents_runs", f"WITH {B.POSITIONED}, t AS (SELECT document_id, pos, coalesce(regexp_matches(content, '([.·…]{{3,}}|\\s)[0-9]{{1,4}}\\s*$'), false) AS toc FROM pb), g AS (SELECT *, CASE WHEN toc IS NOT DISTINCT FROM lag(toc) OVER w AND lag(pos) OVER w IS NOT NULL THEN 0 ELSE 1 END AS c FROM t WINDOW w AS (PARTITION BY document_id ORDER BY pos)), n AS (SELECT *, sum(c) OVER (PARTITION BY document_id ORDER BY pos) AS run FROM g) SELECT document_id, CAST(run AS BIGINT) AS run, min(pos) AS first_pos, count(*) AS blocks FROM n WHERE toc GROUP BY 1, 2")
def _(s, d):
    t = structure.positioned(B.blocks(s, d)).select("document_id", "pos", F.coalesce(F.col("content").rlike(r"([.·…]{3,}|\s)[0-9]{1,4}\s*$"), F.lit(False)).alias("toc"))
    g = structure.islands(t, F.col("toc"), ["document_id"], ["pos"])
    return g.where("toc").groupBy("document_id", F.col("island").alias("run")).agg(F.min("pos").cast("long").alias("first_pos"), F.count("*").alias("blocks"))


@query("q036_ref_validation", f"WITH {B.CONCEPTS} SELECT filename, CASE WHEN title IS NULL OR trim(title) = '' THEN 'no_title' WHEN coalesce(len(source_blocks), 0) = 0 THEN 'no_evidence' WHEN length(trim(body)) < 80 THEN 'container' ELSE 'accepted' END AS verdict FROM lc")
def _(s, d):
    v = F.when(F.col("title").isNull() | (F.trim("title") == ""), "no_title").when(F.coalesce(F.size("source_blocks"), F.lit(0)) <= 0, "no_evidence").when(F.char_length(F.trim("body")) < 80, "container").otherwise("accepted")
    return B.concepts(s, d).select("filename", v.alias("verdict"))


@query("q039_asset_reasons", f"WITH {B.BLOCKS}, i AS (SELECT *, count(*) OVER (PARTITION BY document_id, content) AS repeats FROM lb WHERE block_type = 'image') SELECT block_id, CASE WHEN asset_path IS NULL THEN 'no_asset' WHEN trim(coalesce(content, '')) = '' THEN 'no_text' WHEN repeats >= 3 THEN 'decorative' ELSE 'keep' END AS reason FROM i")
def _(s, d):
    i = B.blocks(s, d).where("block_type = 'image'").withColumn("r", F.count("*").over(W.partitionBy("document_id", "content")))
    return i.select("block_id", F.when(F.col("asset_path").isNull(), "no_asset").when(F.trim(F.coalesce("content", F.lit(""))) == "", "no_text").when(F.col("r") >= 3, "decorative").otherwise("keep").alias("reason"))


@query("q044_missing_images", f"WITH {B.CONCEPTS}, {B.BLOCKS}, k AS (SELECT DISTINCT filename, unnest(regexp_extract_all(body, '!\\[[^\\]]*\\]\\(([^)]*)\\)', 1)) AS target FROM lc) SELECT filename, count(*) AS images, count(*) FILTER (WHERE target NOT IN (SELECT asset_path FROM lb WHERE asset_path IS NOT NULL)) AS missing FROM k GROUP BY 1")
def _(s, d):
    k = B.concepts(s, d).select("filename", F.explode(F.regexp_extract_all("body", F.lit(r"!\[[^\]]*\]\(([^)]*)\)"), 1)).alias("target")).distinct()
    a = B.blocks(s, d).where("asset_path is not null").select(F.col("asset_path").alias("target"), F.lit(1).alias("hit")).distinct()
    return k.join(a, "target", "left").groupBy("filename").agg(F.count("*").alias("images"), F.count_if(F.col("hit").isNull()).alias("missing"))


@query("q045_anchor_information", f"WITH {B.BLOCKS} SELECT title, documents, CASE WHEN length(title) < 4 THEN 'short' WHEN regexp_matches(title, '^[0-9]{{4}}') THEN 'temporal' WHEN documents > 1 THEN 'shared' ELSE 'unique' END AS information FROM (SELECT trim(content) AS title, count(DISTINCT document_id) AS documents FROM lb WHERE block_type = 'title' AND trim(coalesce(content, '')) <> '' GROUP BY 1)")
def _(s, d):
    t = B.blocks(s, d).where("block_type = 'title' and trim(coalesce(content, '')) <> ''").groupBy(F.trim("content").alias("title")).agg(F.count_distinct("document_id").alias("documents"))
    return t.select("title", "documents", F.when(F.char_length("title") < 4, "short").when(F.col("title").rlike("^[0-9]{4}"), "temporal").when(F.col("documents") > 1, "shared").otherwise("unique").alias("information"))


@query("q058_page_citations", f"WITH {B.ATOMS}, {B.CONCEPTS}, r AS (SELECT DISTINCT filename, article_id, page FROM (SELECT filename, unnest(source_blocks) AS block_id FROM lc) JOIN atm USING (block_id)) SELECT filename, r.article_id, r.page, count(*) AS atoms, count(*) FILTER (WHERE block_type = 'text') AS text_atoms FROM r JOIN atm ON atm.article_id = r.article_id AND atm.page = r.page GROUP BY 1, 2, 3")
def _(s, d):
    a = B.atoms(s, d).select("article_id", "page", "block_id", "block_type")
    r = B.concepts(s, d).select("filename", F.explode("source_blocks").alias("block_id")).join(a, "block_id").select("filename", "article_id", "page").distinct()
    return r.join(a, ["article_id", "page"]).groupBy("filename", "article_id", "page").agg(F.count("*").alias("atoms"), F.count_if(F.col("block_type") == "text").alias("text_atoms"))


@query("q059_recovered_pages", f"WITH {B.PAGES} SELECT document_id, page_idx, record_id, attempts FROM lp QUALIFY row_number() OVER (PARTITION BY document_id, page_idx ORDER BY CASE WHEN regexp_matches(lower(coalesce(finish_reason, '')), 'len|max|error') THEN 1 ELSE 0 END, attempts DESC, record_id) = 1")
def _(s, d):
    bad = F.when(F.lower(F.coalesce("finish_reason", F.lit(""))).rlike("len|max|error"), 1).otherwise(0)
    return claims.overlay(B.pages(s, d), ["document_id", "page_idx"], [bad, F.desc("attempts"), F.col("record_id")]).select("document_id", "page_idx", "record_id", "attempts")


_SEG = B.TITLED + ", si AS (SELECT document_id, pos, length(coalesce(content, '')) AS n, block_type = 'title' AS h, row_number() OVER (PARTITION BY document_id ORDER BY pos) AS rn FROM pb), sf AS (SELECT document_id, pos, rn, n AS used, 0 AS sg FROM si WHERE rn = 1 UNION ALL SELECT i.document_id, i.pos, i.rn, CASE WHEN i.h OR f.used >= 1500 OR f.used + i.n + 2 > 2400 THEN i.n ELSE f.used + i.n + 2 END, CASE WHEN i.h OR f.used >= 1500 OR f.used + i.n + 2 > 2400 THEN f.sg + 1 ELSE f.sg END FROM sf f JOIN si i ON i.document_id = f.document_id AND i.rn = f.rn + 1)"


@query("q084_segments", f"WITH RECURSIVE {_SEG} SELECT document_id, sg AS segment, count(*) AS blocks, min(pos) AS first_pos FROM sf GROUP BY 1, 2")
def _(s, d):
    b = structure.positioned(B.blocks(s, d)).select("document_id", "pos", "block_type", F.char_length(F.coalesce("content", F.lit(""))).alias("n"))
    x = claims.segments(b, "document_id", "pos", "n", F.col("block_type") == "title", 1500, 2400)
    return x.groupBy("document_id", "segment").agg(F.count("*").alias("blocks"), F.min("pos").cast("long").alias("first_pos"))


@query("q093_catalog_parts", f"WITH RECURSIVE {B.ATOMS}, ca AS (SELECT article_id, pos, n + length(atom_id) + 30 AS n FROM atm), {B.packing_sql('ca', 'article_id', '6000', 'cp')} SELECT article_id, g AS part, count(*) AS atoms FROM cp GROUP BY 1, 2")
def _(s, d):
    a = B.atoms(s, d).select("article_id", "pos", (F.col("n") + F.char_length("atom_id") + 30).alias("n"))
    return units.pack(a, ["article_id"], "pos", "n", F.lit(6000), "part").groupBy("article_id", "part").agg(F.count("*").alias("atoms"))


@query("q103_ordered_distinct", "SELECT key, min(doc_id) AS first_doc, count(*) AS documents, row_number() OVER (ORDER BY min(doc_id)) AS place FROM (SELECT doc_id, lower(trim(source)) AS key FROM documents WHERE source IS NOT NULL) GROUP BY 1")
def _(s, d):
    x = table(s, d, "documents").where("source is not null").groupBy(F.lower(F.trim("source")).alias("key")).agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("documents"))
    return x.withColumn("place", F.row_number().over(W.orderBy("first_doc")).cast("long"))  # one row a source


@query("q106_exact_cover", f"WITH RECURSIVE {B.T0}, un AS (SELECT unnest(atoms) AS atom_id FROM t0), c AS (SELECT atom_id, count(*) AS k FROM un GROUP BY 1) SELECT count(*) AS atoms, count(c.atom_id) AS covered, count(*) FILTER (WHERE k > 1) AS repeated FROM atm LEFT JOIN c USING (atom_id)")
def _(s, d):
    a = B.atoms(s, d)
    c = units.fixed_chunks(a).select(F.explode("retrieval_atoms").alias("atom_id")).groupBy("atom_id").agg(F.count("*").alias("k"))
    return a.select("atom_id").join(c, "atom_id", "left").agg(F.count("*").alias("atoms"), F.count("k").alias("covered"), F.count_if(F.col("k") > 1).alias("repeated"))


@query("q108_shard_collisions", "WITH h AS (SELECT sha256(text) AS hash, doc_id, doc_id % 2 AS shard FROM documents WHERE text IS NOT NULL) SELECT hash, count(*) FILTER (WHERE shard = 0) AS in_even, count(*) FILTER (WHERE shard = 1) AS in_odd, min(doc_id) AS kept FROM h GROUP BY 1 HAVING count(DISTINCT shard) = 2")
def _(s, d):
    h = table(s, d, "documents").where("text is not null").select(F.sha2("text", 256).alias("hash"), "doc_id", (F.col("doc_id") % 2).alias("shard"))
    return h.groupBy("hash").agg(F.count_if(F.col("shard") == 0).alias("in_even"), F.count_if(F.col("shard") == 1).alias("in_odd"), F.min("doc_id").alias("kept")).where("in_even > 0 and in_odd > 0")


@query("q117_sentence_catalog", r"WITH " + B.CONCEPTS + r", se AS (SELECT filename, unnest(list_filter(list_transform(regexp_extract_all(body, '([^。！？!?；;\n]+[。！？!?；;]*)', 1), lambda x: trim(x)), lambda x: x <> '')) AS sentence FROM lc) SELECT filename, count(*) AS sentences, count(DISTINCT sentence) AS distinct_sentences FROM se GROUP BY 1")
def _(s, d):
    parts = F.filter(F.transform(F.regexp_extract_all("body", F.lit("([^。！？!?；;\n]+[。！？!?；;]*)"), 1), lambda x: F.trim(x)), lambda x: x != "")
    return B.concepts(s, d).select("filename", F.explode(parts).alias("sentence")).groupBy("filename").agg(F.count("*").alias("sentences"), F.count_distinct("sentence").alias("distinct_sentences"))


@query("q122_contents_lines", f"WITH {B.BLOCKS}, l AS (SELECT block_id, trim(content) AS t FROM lb WHERE block_type IN ('title', 'header', 'list')) SELECT block_id, regexp_extract(t, '^(.*?\\S)(?:[ .·…　]{{2,}}|\\s+)([0-9]{{1,4}})\\s*$', 1) AS title, CAST(regexp_extract(t, '^(.*?\\S)(?:[ .·…　]{{2,}}|\\s+)([0-9]{{1,4}})\\s*$', 2) AS INT) AS page FROM l WHERE regexp_matches(t, '^(.*?\\S)(?:[ .·…　]{{2,}}|\\s+)([0-9]{{1,4}})\\s*$')")
def _(s, d):
    t = F.trim("content")
    title, page = claims.toc_line(t)
    x = B.blocks(s, d).where("block_type in ('title', 'header', 'list')").where(t.rlike(r"^(.*?\S)(?:[ .·…　]{2,}|\s+)([0-9]{1,4})\s*$"))
    return x.select("block_id", title.alias("title"), page.alias("page"))


@query("q124_recovered_parts", f"WITH {B.PAGES}, p AS (SELECT record_id, unnest(list_filter(string_split(content, chr(10) || chr(10)), lambda x: trim(x) <> '')) AS part FROM lp WHERE content IS NOT NULL) SELECT record_id, count(*) FILTER (WHERE regexp_matches(part, '^#{{1,6}} ')) AS headings, count(*) FILTER (WHERE regexp_matches(part, '^(\\||<table)')) AS tables, count(*) FILTER (WHERE NOT regexp_matches(part, '^(#{{1,6}} |\\||<table)')) AS paragraphs FROM p GROUP BY 1")
def _(s, d):
    p = B.pages(s, d).where("content is not null").select("record_id", F.explode(F.filter(F.split("content", "\n\n"), lambda x: F.trim(x) != "")).alias("part"))
    c = F.col("part")
    return p.groupBy("record_id").agg(F.count_if(c.rlike("^#{1,6} ")).alias("headings"), F.count_if(c.rlike(r"^(\||<table)")).alias("tables"), F.count_if(~c.rlike(r"^(#{1,6} |\||<table)")).alias("paragraphs"))


@query("q126_section_level", f"WITH {B.TITLED}, c AS (SELECT document_id, level, count(*) AS n FROM tb WHERE level IS NOT NULL GROUP BY 1, 2), u AS (SELECT *, sum(n) OVER (PARTITION BY document_id ORDER BY level) AS upto, max(level) OVER (PARTITION BY document_id) AS deepest FROM c) SELECT document_id, coalesce(min(level) FILTER (WHERE upto >= 4), any_value(deepest)) AS section_level, CAST(sum(n) AS BIGINT) AS headings FROM u GROUP BY 1")
def _(s, d):
    c = B.blocks(s, d).where("block_type = 'title'").withColumn("level", structure.heading_level(F.col("heading_level"), F.col("block_type"))).groupBy("document_id", "level").agg(F.count("*").alias("n"))
    u = c.withColumn("upto", F.sum("n").over(W.partitionBy("document_id").orderBy("level")))
    return u.groupBy("document_id").agg(F.coalesce(F.min(F.when(F.col("upto") >= 4, F.col("level"))), F.max("level")).alias("section_level"), F.sum("n").alias("headings"))


@query("q129_document_profile", f"WITH {B.POSITIONED} SELECT document_id, count(*) AS blocks, count(*) FILTER (WHERE block_type = 'title') AS headings, count(*) FILTER (WHERE block_type IN ('table', 'image')) AS assets, CAST(sum(length(coalesce(content, ''))) AS BIGINT) AS chars, count(DISTINCT page_idx) AS pages, left(arg_min(content, pos) FILTER (WHERE block_type = 'text' AND content IS NOT NULL), 120) AS preview FROM pb GROUP BY 1")
def _(s, d):
    b = structure.positioned(B.blocks(s, d))
    first = F.min_by("content", F.when((F.col("block_type") == "text") & F.col("content").isNotNull(), F.col("pos")))
    return b.groupBy("document_id").agg(F.count("*").alias("blocks"), F.count_if(F.col("block_type") == "title").alias("headings"), F.count_if(F.col("block_type").isin("table", "image")).alias("assets"), F.sum(F.char_length(F.coalesce("content", F.lit("")))).alias("chars"), F.count_distinct("page_idx").alias("pages"), F.left(first, F.lit(120)).alias("preview"))


@query("q132_asset_inventory", f"WITH {B.CONCEPTS} SELECT filename, len(regexp_extract_all(body, '!\\[[^\\]]*\\]\\([^)]*\\)')) AS images, len(regexp_extract_all(body, '<table')) AS html_tables, len(regexp_extract_all(body, '\\| --- \\|')) AS pipe_tables FROM lc")
def _(s, d):
    n = lambda p: F.regexp_count("body", F.lit(p)).cast("long")
    return B.concepts(s, d).select("filename", n(r"!\[[^\]]*\]\([^)]*\)").alias("images"), n("<table").alias("html_tables"), n(r"\| --- \|").alias("pipe_tables"))


_LINKLESS = "regexp_replace(regexp_replace({}, '!?\\[([^\\]]*)\\]\\([^)]*\\)', '\\1', 'g'), '\\[\\[[^\\]]*\\]\\]', '', 'g')"


@query("q133_without_links", f"WITH {B.CONCEPTS} SELECT filename, sha256({_LINKLESS.format('body')}) AS plain_hash, {_LINKLESS.format('body')} = body AS had_none FROM lc")
def _(s, d):
    plain = F.regexp_replace(F.regexp_replace("body", r"!?\[([^\]]*)\]\([^)]*\)", "$1"), r"\[\[[^\]]*\]\]", "")
    return B.concepts(s, d).select("filename", F.sha2(plain, 256).alias("plain_hash"), (plain == F.col("body")).alias("had_none"))


@query("q148_semantic_keys", f"WITH {B.CONCEPTS} SELECT filename, coalesce(nullif(json_extract_string(frontmatter, '$.family'), ''), nullif(json_extract_string(frontmatter, '$.key'), ''), lower(concept_type) || ':' || lower(regexp_replace(trim(coalesce(title, '')), '\\s+', ' ', 'g'))) AS semantic_key FROM lc")
def _(s, d):
    own = F.concat(F.lower("concept_type"), F.lit(":"), F.lower(F.regexp_replace(F.trim(F.coalesce("title", F.lit(""))), r"\s+", " ")))
    return B.concepts(s, d).select("filename", F.coalesce(F.nullif(F.get_json_object("frontmatter", "$.family"), F.lit("")), F.nullif(F.get_json_object("frontmatter", "$.key"), F.lit("")), own).alias("semantic_key"))


@query("q150_evidence_fingerprint", f"WITH {B.ATOMS}, {B.CONCEPTS} SELECT filename, sha256(string_agg(regexp_replace(text, '[ \\t\\n\\r\\f]+', '', 'g'), chr(31) ORDER BY atom_id)) AS fingerprint, count(*) AS pieces FROM (SELECT filename, unnest(list_distinct(source_blocks)) AS block_id FROM lc) JOIN atm USING (block_id) GROUP BY 1")
def _(s, d):
    r = B.concepts(s, d).select("filename", F.explode(F.array_distinct("source_blocks")).alias("block_id")).join(B.atoms(s, d).select("block_id", "atom_id", "text"), "block_id")
    g = r.groupBy("filename").agg(F.array_sort(F.collect_list(F.struct("atom_id", F.regexp_replace("text", r"[ \t\n\r\f]+", "").alias("t")))).alias("x"))
    return g.select("filename", F.sha2(F.array_join(F.transform("x", lambda v: v["t"]), "\x1f"), 256).alias("fingerprint"), F.size("x").cast("long").alias("pieces"))


@query("q177_gold_slots", f"WITH {B.ATOMS}, q AS (SELECT article_id, atom_id, block_type, row_number() OVER (PARTITION BY article_id, block_type ORDER BY sha256(atom_id), atom_id) AS slot FROM atm) SELECT article_id, atom_id, block_type, slot FROM q WHERE slot <= CASE block_type WHEN 'text' THEN 3 WHEN 'list' THEN 2 WHEN 'table' THEN 1 WHEN 'equation' THEN 1 WHEN 'code' THEN 1 ELSE 0 END")
def _(s, d):
    x = claims.quota_sample(B.atoms(s, d), ["article_id"], "block_type", {"text": 3, "list": 2, "table": 1, "equation": 1, "code": 1}, "atom_id")
    return x.select("article_id", "atom_id", "block_type", F.col("slot").cast("long"))


def _facts(s, d):
    num = lambda c: F.explode(F.array_distinct(F.regexp_extract_all(c, F.lit(r"([0-9]+(?:[.,][0-9]+)*)"), 1))).alias("fact_id")
    c = B.concepts(s, d)
    ev = c.select(F.col("filename").alias("question_id"), F.explode(F.array_distinct("source_blocks")).alias("block_id")).join(B.atoms(s, d).select("block_id", "text"), "block_id").select("question_id", num("text")).distinct()
    required = ev.select("question_id", "fact_id", F.char_length("fact_id").cast("double").alias("weight"), (F.char_length("fact_id") >= 5).alias("critical"))
    claimed = c.select(F.col("filename").alias("question_id"), num("body"))
    q = c.select(F.col("filename").alias("question_id"), (F.coalesce(F.size("source_blocks"), F.lit(0)) > 0).alias("answerable"), (F.char_length("body") > 0).alias("predicted_answerable"))
    return required, claimed, q


@query("q181_answer_scores", f"""WITH {B.ATOMS}, {B.CONCEPTS}, rq AS (SELECT DISTINCT filename, unnest(regexp_extract_all(text, '([0-9]+(?:[.,][0-9]+)*)', 1)) AS f FROM (SELECT filename, unnest(list_distinct(source_blocks)) AS block_id FROM lc) JOIN atm USING (block_id)), cl AS (SELECT DISTINCT filename, unnest(regexp_extract_all(body, '([0-9]+(?:[.,][0-9]+)*)', 1)) AS f FROM lc),
 r AS (SELECT rq.filename, sum(length(rq.f))::DOUBLE AS total, coalesce(sum(length(rq.f)) FILTER (WHERE cl.f IS NOT NULL), 0)::DOUBLE AS matched, bool_and(length(rq.f) < 5 OR cl.f IS NOT NULL) AS ok FROM rq LEFT JOIN cl ON cl.filename = rq.filename AND cl.f = rq.f GROUP BY 1), o AS (SELECT cl.filename, count(*) FILTER (WHERE rq.f IS NULL) AS unknown, count(*) AS n FROM cl LEFT JOIN rq ON cl.filename = rq.filename AND cl.f = rq.f GROUP BY 1)
 SELECT lc.filename AS question_id, round(matched / total, 6) AS fact_recall, CASE WHEN total IS NOT NULL THEN round(CASE WHEN matched + coalesce(unknown, 0) > 0 THEN matched / (matched + coalesce(unknown, 0)) ELSE 0 END, 6) END AS fact_precision, coalesce(ok, true) AS critical_ok, CASE WHEN coalesce(len(source_blocks), 0) > 0 THEN length(body) > 0 AND coalesce(ok, true) AND coalesce(unknown, 0) = 0 ELSE NOT length(body) > 0 AND coalesce(n, 0) = 0 END AS correct FROM lc LEFT JOIN r USING (filename) LEFT JOIN o USING (filename)""")
def _(s, d):
    required, claimed, q = _facts(s, d)
    x = claims.answer_scores(required, required.limit(0), claimed, q)
    return x.select("question_id", F.round("fact_recall", 6).alias("fact_recall"), F.round("fact_precision", 6).alias("fact_precision"), "critical_ok", "correct")


@query("q201_update_audit", f"WITH {B.BLOCKS}, h AS (SELECT source_file, document_id, sha256(string_agg(block_id, ',' ORDER BY block_id)) AS now, sha256(string_agg(block_id, ',' ORDER BY block_id) || CASE WHEN substr(sha256(document_id), 1, 1) < '4' THEN 'x' ELSE '' END) AS before FROM lb GROUP BY 1, 2) SELECT source_file, count(*) AS documents, count(*) FILTER (WHERE now = before) AS reused, round(count(*) FILTER (WHERE now = before) / count(*), 6) AS reuse_rate FROM h GROUP BY 1")
def _(s, d):
    g = B.blocks(s, d).groupBy("source_file", "document_id").agg(F.array_join(F.array_sort(F.collect_list("block_id")), ",").alias("b"))
    changed = F.when(F.substring(F.sha2("document_id", 256), 1, 1) < "4", F.lit("x")).otherwise("")
    same = F.sha2("b", 256) == F.sha2(F.concat("b", changed), 256)
    return g.groupBy("source_file").agg(F.count("*").alias("documents"), F.count_if(same).alias("reused"), F.round(F.count_if(same) / F.count("*"), 6).alias("reuse_rate"))


@query("q218_redacted_links", "SELECT doc_id, regexp_replace(text, 'https?://[A-Za-z0-9./_-]+', '[LINK]', 'g') AS redacted FROM documents WHERE text LIKE '%http%'")
def _(s, d):
    return table(s, d, "documents").where("text like '%http%'").select("doc_id", F.regexp_replace("text", "https?://[A-Za-z0-9./_-]+", "[LINK]").alias("redacted"))


@query("q219_defect_worklist", f"WITH {B.PAGES} SELECT document_id, count(*) AS defects, string_agg(DISTINCT finish_reason, '|' ORDER BY finish_reason) AS reasons, min(page_idx) AS first_page FROM lp WHERE regexp_matches(lower(finish_reason), 'len|max|error') GROUP BY 1")
def _(s, d):
    x = B.pages(s, d).where(F.lower("finish_reason").rlike("len|max|error"))
    return x.groupBy("document_id").agg(F.count("*").alias("defects"), F.array_join(F.array_sort(F.collect_set("finish_reason")), "|").alias("reasons"), F.min("page_idx").alias("first_page"))


@query("q239_annotation_sheet", f"WITH {B.ATOMS} SELECT atom_id, article_id, page, left(text, 800) AS excerpt, length(text) > 800 AS cut FROM atm WHERE block_type IN ('text', 'list', 'table')")
def _(s, d):
    return B.atoms(s, d).where("block_type in ('text', 'list', 'table')").select("atom_id", "article_id", "page", F.left("text", F.lit(800)).alias("excerpt"), (F.char_length("text") > 800).alias("cut"))


@query("q245_checksum_manifest", f"WITH {B.CONCEPTS} SELECT concept_type, count(*) AS files, sha256(string_agg(filename || ':' || sha256(coalesce(body, '')), chr(10) ORDER BY filename)) AS manifest_hash FROM lc GROUP BY 1")
def _(s, d):
    g = B.concepts(s, d).groupBy("concept_type").agg(F.array_sort(F.collect_list(F.concat_ws(":", "filename", F.sha2(F.coalesce("body", F.lit("")), 256)))).alias("m"))
    return g.select("concept_type", F.size("m").cast("long").alias("files"), F.sha2(F.array_join("m", "\n"), 256).alias("manifest_hash"))


@query("x5_set_operations", "SELECT key, 'both' AS side FROM (SELECT DISTINCT c_nationkey AS key FROM customer INTERSECT SELECT s_nationkey FROM supplier) UNION ALL SELECT key, 'customers_only' FROM (SELECT DISTINCT c_nationkey AS key FROM customer EXCEPT SELECT s_nationkey FROM supplier)")
def _(s, d):
    c = table(s, d, "customer").select(F.col("c_nationkey").alias("key")).distinct()
    p = table(s, d, "supplier").select(F.col("s_nationkey").alias("key"))
    return c.intersect(p).withColumn("side", F.lit("both")).unionByName(c.subtract(p).withColumn("side", F.lit("customers_only")))


@query("x6_top_per_group", "SELECT n_name, c_custkey, c_acctbal FROM customer JOIN nation ON n_nationkey = c_nationkey QUALIFY row_number() OVER (PARTITION BY n_name ORDER BY c_acctbal DESC, c_custkey) <= 3")
def _(s, d):
    c = table(s, d, "customer").join(table(s, d, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    return c.withColumn("k", F.row_number().over(W.partitionBy("n_name").orderBy(F.desc("c_acctbal"), "c_custkey"))).where("k <= 3").select("n_name", "c_custkey", "c_acctbal")


@query("x7_pivot", "SELECT l_returnflag, round(sum(l_quantity) FILTER (WHERE l_linestatus = 'F'), 2) AS filled, round(sum(l_quantity) FILTER (WHERE l_linestatus = 'O'), 2) AS open FROM lineitem GROUP BY 1")
def _(s, d):
    p = table(s, d, "lineitem").groupBy("l_returnflag").pivot("l_linestatus", ["F", "O"]).agg(F.round(F.sum("l_quantity"), 2))
    return p.withColumnsRenamed({"F": "filled", "O": "open"})


@query("x8_cube", "SELECT l_returnflag, l_linestatus, count(*) AS n, round(avg(l_discount), 4) AS discount FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def _(s, d):
    return table(s, d, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.avg("l_discount"), 4).alias("discount"))
