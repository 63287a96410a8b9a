"""Queries over parsed documents: deliveries, structure, units."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from inkwell.functions import text as X
from inkwell.operators import records, structure, units
from inkwell.plans import base as B
from inkwell.session import table

Q: dict[str, tuple] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        Q[name] = (f, sql)
        return f

    return add


@query("q001_latest_blocks", f"WITH {B.BLOCKS} SELECT block_id, document_id, page_idx, reading_order, loaded_at FROM lb")
def _(s, d):
    return B.blocks(s, d).select("block_id", "document_id", "page_idx", "reading_order", "loaded_at")


@query("q002_delivery_audit", "SELECT 'blocks' AS source_table, count(*) AS delivered, count(DISTINCT block_id) AS distinct_keys FROM blocks UNION ALL SELECT 'page_results', count(*), count(DISTINCT record_id) FROM page_results UNION ALL SELECT 'document_ir', count(*), count(DISTINCT document_id) FROM document_ir UNION ALL SELECT 'concept_documents', count(*), count(DISTINCT filename) FROM concept_documents")
def _(s, d):
    parts = [table(s, d, t).agg(F.lit(t).alias("source_table"), F.count("*").alias("delivered"), F.count_distinct(k).alias("distinct_keys")) for t, k in (("blocks", "block_id"), ("page_results", "record_id"), ("document_ir", "document_id"), ("concept_documents", "filename"))]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


@query("q003_heading_levels", f"WITH {B.BLOCKS} SELECT block_type, CASE WHEN heading_level BETWEEN 1 AND 6 THEN heading_level WHEN block_type = 'title' THEN 1 END AS level, count(*) AS n FROM lb GROUP BY 1, 2")
def _(s, d):
    return B.blocks(s, d).groupBy("block_type", structure.heading_level(F.col("heading_level"), F.col("block_type")).alias("level")).agg(F.count("*").alias("n"))


@query("q005_evidence_atoms", f"WITH {B.ATOMS} SELECT atom_id, article_id, page, block_type, text, n FROM atm")
def _(s, d):
    return B.atoms(s, d).select("atom_id", "article_id", "page", "block_type", "text", "n")


@query("q006_complete_pages", f"WITH {B.PAGES} SELECT document_id, count(*) AS pages, count(DISTINCT page_idx) AS distinct_pages, CAST(sum(attempts) AS BIGINT) AS attempts FROM lp WHERE status = 'complete' GROUP BY document_id")
def _(s, d):
    return B.pages(s, d).where("status = 'complete'").groupBy("document_id").agg(F.count("*").alias("pages"), F.count_distinct("page_idx").alias("distinct_pages"), F.sum("attempts").alias("attempts"))


_HASH = "sha256(coalesce(content, '') || chr(0) || coalesce(asset_path, ''))"


@query("q007_hash_status", f"WITH {B.BLOCKS} SELECT block_id, CASE WHEN content_hash IS NULL OR trim(content_hash) = '' THEN 'missing' WHEN content_hash = {_HASH} THEN 'ok' WHEN regexp_replace(lower(trim(content_hash)), '^sha-?256:', '') = {_HASH} THEN 'spelling' ELSE 'stale' END AS hash_status FROM lb")
def _(s, d):
    return records.hash_status(B.blocks(s, d), "content", "asset_path", "content_hash").select("block_id", "hash_status")


@query("q008_unique_keys", f"WITH {B.PAGES} SELECT document_id, page_idx, count(*) AS parses FROM lp GROUP BY 1, 2 HAVING count(*) > 1")
def _(s, d):
    return B.pages(s, d).groupBy("document_id", "page_idx").agg(F.count("*").alias("parses")).where("parses > 1")


@query("q013_front_matter", f"WITH {B.CONCEPTS} SELECT filename, json_extract_string(frontmatter, '$.type') AS fm_type, json_extract_string(frontmatter, '$.title') AS fm_title, frontmatter IS NULL AS missing FROM lc")
def _(s, d):
    return B.concepts(s, d).select("filename", F.get_json_object("frontmatter", "$.type").alias("fm_type"), F.get_json_object("frontmatter", "$.title").alias("fm_title"), F.col("frontmatter").isNull().alias("missing"))


_GENERIC = ", ".join(f"'{g}'" for g in structure.GENERIC)


@query("q025_inferred_titles", f"WITH {B.BLOCKS} SELECT document_id, title, page_idx FROM (SELECT document_id, page_idx, block_id, trim(content) AS title FROM lb WHERE block_type = 'title' AND page_idx < 12) WHERE length(title) BETWEEN 4 AND 120 AND lower(title) NOT IN ({_GENERIC}) QUALIFY row_number() OVER (PARTITION BY document_id ORDER BY page_idx, length(title) DESC, title, block_id) = 1")
def _(s, d):
    return structure.inferred_title(B.blocks(s, d))


@query("q030_eligibility", f"WITH {B.BLOCKS} SELECT block_type, evidence_eligible, count(*) AS n, count(*) FILTER (WHERE trim(coalesce(content, '')) = '') AS blank FROM lb GROUP BY 1, 2")
def _(s, d):
    return B.blocks(s, d).groupBy("block_type", "evidence_eligible").agg(F.count("*").alias("n"), F.count_if(F.trim(F.coalesce("content", F.lit(""))) == "").alias("blank"))


_ROLES = f"""WITH {B.BLOCKS}, pg AS (SELECT document_id, page_idx, CAST(sum(length(trim(coalesce(content, '')))) AS BIGINT) AS chars, count(*) AS blocks, count(*) FILTER (WHERE block_type = 'title') AS titles, count(*) FILTER (WHERE block_type = 'image') AS images,
 count(*) FILTER (WHERE regexp_matches(content, '[.·…]{{3,}}\\s*[0-9]+\\s*$|^(目录|[Cc]ontents)\\s*$')) AS toc_lines, count(*) FILTER (WHERE block_type IN ('text', 'list', 'table', 'code', 'equation') AND length(trim(coalesce(content, ''))) > 0) AS bodies FROM lb WHERE page_idx IS NOT NULL GROUP BY 1, 2),
 pr AS (SELECT *, CASE WHEN toc_lines >= 3 THEN 'toc' WHEN chars = 0 THEN CASE WHEN images > 0 THEN 'image' ELSE 'blank' END WHEN page_idx = 0 AND bodies = 0 THEN 'cover' WHEN titles > 0 AND bodies = 0 THEN 'section_divider' ELSE 'content' END AS role FROM pg)"""


@query("q031_page_roles", f"{_ROLES} SELECT document_id, page_idx, chars, blocks, titles, bodies, role FROM pr")
def _(s, d):
    return structure.page_roles(B.blocks(s, d)).select("document_id", "page_idx", "chars", "blocks", "titles", "bodies", "role")


@query("q034_heading_noise", f"WITH {B.BLOCKS} SELECT block_id, regexp_matches(trim(content), '^[0-9 .·—–-]*$') AS bare_marker, regexp_matches(trim(content), '^(Contents|References|Annex|Anhang|Annexe|Anexo|目录|附录)') AS furniture FROM lb WHERE block_type = 'title' AND content IS NOT NULL")
def _(s, d):
    t = F.trim("content")
    return B.blocks(s, d).where("block_type = 'title' and content is not null").select("block_id", t.rlike("^[0-9 .·—–-]*$").alias("bare_marker"), t.rlike("^(Contents|References|Annex|Anhang|Annexe|Anexo|目录|附录)").alias("furniture"))


@query("q035_substantive_segments", rf"WITH {B.SEGMENTS} SELECT segment_id, length(body) AS body_chars FROM (SELECT segment_id, trim(regexp_replace(regexp_replace(content, '(?m)^#{{1,6}} [^\n]*$', '', 'g'), '!\[[^\]\n]*\]\([^)\n]*\)', '', 'g'), chr(10) || ' ') AS body FROM ls) WHERE length(body) > 0")
def _(s, d):
    body = F.trim(F.regexp_replace(F.regexp_replace("content", r"(?m)^#{1,6} [^\n]*$", ""), r"!\[[^\]\n]*\]\([^)\n]*\)", ""), F.lit("\n "))
    return B.segments(s, d).select("segment_id", F.char_length(body).alias("body_chars")).where("body_chars > 0")


@query("q037_container_headings", f"""WITH {B.TITLED}, h AS (SELECT document_id, block_id, level, pos, lead(pos) OVER w AS next_pos, lead(level) OVER w AS next_level FROM tb WHERE level IS NOT NULL WINDOW w AS (PARTITION BY document_id ORDER BY pos))
 SELECT h.document_id, h.block_id, h.level, CAST(coalesce(sum(length(trim(coalesce(b.content, '')))), 0) AS BIGINT) AS body_chars FROM h LEFT JOIN pb b ON b.document_id = h.document_id AND b.pos > h.pos AND b.pos < h.next_pos AND b.block_type <> 'title' WHERE next_level > level GROUP BY 1, 2, 3 HAVING coalesce(sum(length(trim(coalesce(b.content, '')))), 0) < 200""")
def _(s, d):
    return structure.container_headings(B.blocks(s, d)).select("document_id", "block_id", "level", F.col("body_chars").cast("long"))


@query("q042_anomaly_exclusion", r"""WITH f AS (SELECT DISTINCT fragment_id, text, source_text_anomalies AS an FROM excluded_fragments WHERE text IS NOT NULL), se AS (SELECT fragment_id, an, unnest(list_filter(list_transform(regexp_extract_all(text, '([^。！？!?；;.]+[。！？!?；;.]*)', 1), lambda x: trim(x)), lambda x: x <> '')) AS sentence FROM f)
 SELECT fragment_id, count(*) AS sentences, count(*) FILTER (WHERE coalesce(len(list_filter(an, lambda a: a <> '' AND contains(sentence, a))), 0) > 0) AS excluded FROM se GROUP BY fragment_id""")
def _(s, d):
    f = table(s, d, "excluded_fragments").where("text is not null").dropDuplicates(["fragment_id"])
    parts = F.filter(F.transform(F.regexp_extract_all("text", F.lit(r"([^。！？!?；;.]+[。！？!?；;.]*)"), 1), lambda x: F.trim(x)), lambda x: x != "")
    se = f.select("fragment_id", F.col("source_text_anomalies").alias("an"), F.explode(parts).alias("sentence"))
    bad = F.coalesce(F.exists("an", lambda a: (a != "") & F.col("sentence").contains(a)), F.lit(False))
    return se.groupBy("fragment_id").agg(F.count("*").alias("sentences"), F.count_if(bad).alias("excluded"))


@query("q043_unreadable_characters", f"WITH {B.BLOCKS} SELECT block_type, count(*) AS n, count(*) FILTER (WHERE regexp_matches(content, '[\\x{{FFFD}}\\x{{E000}}-\\x{{F8FF}}]')) AS suspicious FROM lb GROUP BY 1")
def _(s, d):
    return B.blocks(s, d).groupBy("block_type").agg(F.count("*").alias("n"), F.count_if(F.col("content").rlike(r"[\x{FFFD}\x{E000}-\x{F8FF}]")).alias("suspicious"))


@query("q049_fragment_containment", f"WITH {B.BLOCKS} SELECT f.fragment_id, f.block_id, b.content IS NOT NULL AND contains(regexp_replace(b.content, '[ \\t\\n\\r\\f]+', '', 'g'), regexp_replace(f.text, '[ \\t\\n\\r\\f]+', '', 'g')) AS contained FROM (SELECT DISTINCT fragment_id, block_id, text FROM excluded_fragments WHERE text IS NOT NULL AND block_id IS NOT NULL) f LEFT JOIN lb b ON f.block_id = b.block_id")
def _(s, d):
    bare = lambda c: F.regexp_replace(c, r"[ \t\n\r\f]+", "")
    f = table(s, d, "excluded_fragments").where("text is not null and block_id is not null").select("fragment_id", "block_id", "text").distinct()
    j = f.join(B.blocks(s, d).select("block_id", "content"), "block_id", "left")
    return j.select("fragment_id", "block_id", F.coalesce(bare(F.col("content")).contains(bare(F.col("text"))), F.lit(False)).alias("contained"))


@query("q050_excerpt_location", f"""WITH {B.POSITIONED}, nx AS (SELECT block_id, regexp_replace(coalesce(content, ''), '[ \\t\\n\\r\\f]+', '', 'g') AS own, regexp_replace(coalesce(lead(content) OVER (PARTITION BY document_id ORDER BY pos), ''), '[ \\t\\n\\r\\f]+', '', 'g') AS next FROM pb)
 SELECT f.fragment_id, CASE WHEN nx.block_id IS NULL THEN 'dangling' WHEN contains(own, tx) THEN 'block' WHEN contains(own || next, tx) THEN 'pair' ELSE 'none' END AS place FROM (SELECT DISTINCT fragment_id, block_id, regexp_replace(text, '[ \\t\\n\\r\\f]+', '', 'g') AS tx FROM excluded_fragments WHERE text IS NOT NULL AND block_id IS NOT NULL) f LEFT JOIN nx USING (block_id)""")
def _(s, d):
    bare = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), r"[ \t\n\r\f]+", "")
    b = structure.positioned(B.blocks(s, d).select("document_id", "block_id", "page_idx", "reading_order", "content"))
    nx = b.select("block_id", bare(F.col("content")).alias("own"), bare(F.lead("content").over(W.partitionBy("document_id").orderBy("pos"))).alias("next"))
    f = table(s, d, "excluded_fragments").where("text is not null and block_id is not null").select("fragment_id", "block_id", bare(F.col("text")).alias("tx")).distinct()
    place = F.when(F.col("own").isNull(), "dangling").when(F.col("own").contains(F.col("tx")), "block").when(F.concat("own", "next").contains(F.col("tx")), "pair").otherwise("none")
    return f.join(nx, "block_id", "left").select("fragment_id", place.alias("place"))


@query("q082_heading_islands", f"""WITH {B.ATOMS}, m AS (SELECT article_id, pos, array_to_string(coalesce(heading_path, []), ' > ') AS prefix FROM atm), i AS (SELECT *, CASE WHEN lag(pos) OVER w IS NOT NULL AND prefix IS NOT DISTINCT FROM lag(prefix) OVER w THEN 0 ELSE 1 END AS c FROM m WINDOW w AS (PARTITION BY article_id ORDER BY pos)),
 n AS (SELECT article_id, prefix, pos, sum(c) OVER (PARTITION BY article_id ORDER BY pos) AS island FROM i) SELECT article_id, CAST(island AS BIGINT) AS island, min(prefix) AS prefix, count(*) AS atoms FROM n GROUP BY 1, 2""")
def _(s, d):
    prefix = F.array_join(F.coalesce("heading_path", F.expr("cast(array() as array<string>)")), " > ")
    a = structure.islands(B.atoms(s, d).withColumn("prefix", prefix), F.col("prefix"), ["article_id"], ["pos"])
    return a.groupBy("article_id", "island").agg(F.min("prefix").alias("prefix"), F.count("*").alias("atoms"))


@query("q085_heading_stack", f"""WITH {B.TITLED}, w AS (SELECT document_id, block_id, pos, {', '.join(f"max(CASE WHEN level = {n} THEN pos END) OVER u AS p{n}" for n in range(1, 7))} FROM tb WINDOW u AS (PARTITION BY document_id ORDER BY pos ROWS UNBOUNDED PRECEDING)),
 k AS (SELECT document_id, block_id, unnest([{', '.join(f"CASE WHEN p{n} > greatest({', '.join(['0'] + [f'coalesce(p{m}, 0)' for m in range(1, n)])}) THEN p{n} END" for n in range(1, 7))}]) AS p FROM w)
 SELECT k.block_id, coalesce(string_agg(trim(coalesce(t.content, '')), ' > ' ORDER BY k.p) FILTER (WHERE t.pos IS NOT NULL), '') AS running_path, count(t.pos) AS depth FROM k LEFT JOIN pb t ON t.document_id = k.document_id AND t.pos = k.p GROUP BY k.block_id""")
def _(s, d):
    return structure.heading_stack(B.blocks(s, d)).select("block_id", F.array_join("running_path", " > ").alias("running_path"), F.size("running_path").cast("long").alias("depth"))


@query("q086_marker_merge", f"""WITH {B.POSITIONED}, n AS (SELECT block_id, document_id, block_type, page_idx, trim(content) AS t, lead(block_type) OVER w AS nt, lead(page_idx) OVER w AS np, lead(trim(content)) OVER w AS nc, lead(block_id) OVER w AS nb FROM pb WINDOW w AS (PARTITION BY document_id ORDER BY pos))
 SELECT block_id, nb AS next_block_id, t || ' ' || nc AS merged FROM n WHERE block_type IN ('title', 'text') AND regexp_matches(t, '^(?:[0-9]+(?:\\.[0-9]+)*\\.?|[IVXLC]+\\.?|[A-Z]\\.)$') AND nt = 'title' AND np = page_idx""")
def _(s, d):
    w = W.partitionBy("document_id").orderBy("pos")
    b = structure.positioned(B.blocks(s, d)).withColumn("t", F.trim("content"))
    n = b.select("block_id", "block_type", "page_idx", "t", F.lead("block_type").over(w).alias("nt"), F.lead("page_idx").over(w).alias("np"), F.lead("t").over(w).alias("nc"), F.lead("block_id").over(w).alias("nb"))
    return n.where(F.col("block_type").isin("title", "text") & F.col("t").rlike(r"^(?:[0-9]+(?:\.[0-9]+)*\.?|[IVXLC]+\.?|[A-Z]\.)$") & (F.col("nt") == "title") & (F.col("np") == F.col("page_idx"))).select("block_id", F.col("nb").alias("next_block_id"), F.concat_ws(" ", "t", "nc").alias("merged"))


@query("q087_section_extent", f"""WITH {B.TITLED}, h AS (SELECT * FROM tb WHERE level IS NOT NULL), l AS (SELECT document_id, max(pos) AS last FROM pb GROUP BY 1)
 SELECT a.document_id, a.block_id, a.level, a.pos, coalesce(min(b.pos) - 1, any_value(l.last)) AS end_pos FROM h a JOIN l USING (document_id) LEFT JOIN h b ON a.document_id = b.document_id AND b.pos > a.pos AND b.level <= a.level GROUP BY 1, 2, 3, 4""")
def _(s, d):
    e = structure.section_extent(B.blocks(s, d))
    return e.select("document_id", "block_id", "level", F.col("pos").cast("long"), F.col("end_pos").cast("long"))


@query("q088_neighbour_pairs", f"WITH {B.ATOMS} SELECT article_id, atom_id, next_atom_id FROM (SELECT article_id, atom_id, lead(atom_id) OVER (PARTITION BY article_id, array_to_string(coalesce(heading_path, []), ' > ') ORDER BY pos) AS next_atom_id FROM atm) WHERE next_atom_id IS NOT NULL")
def _(s, d):
    prefix = F.array_join(F.coalesce("heading_path", F.expr("cast(array() as array<string>)")), " > ")
    a = B.atoms(s, d).select("article_id", "atom_id", F.lead("atom_id").over(W.partitionBy("article_id", prefix).orderBy("pos")).alias("next_atom_id"))
    return a.where("next_atom_id is not null")


@query("q089_round_robin", f"WITH {B.ATOMS}, r AS (SELECT article_id, atom_id, page, sha256(atom_id) AS h, row_number() OVER (PARTITION BY article_id, page ORDER BY sha256(atom_id)) AS n FROM atm) SELECT article_id, atom_id, row_number() OVER (PARTITION BY article_id ORDER BY n, h) AS turn FROM r")
def _(s, d):
    r = B.atoms(s, d).select("article_id", "atom_id", "page", F.sha2("atom_id", 256).alias("h"))
    r = r.withColumn("n", F.row_number().over(W.partitionBy("article_id", "page").orderBy("h")))
    return r.select("article_id", "atom_id", F.row_number().over(W.partitionBy("article_id").orderBy("n", "h")).cast("long").alias("turn"))


@query("q091_ordinal_assets", f"WITH {B.POSITIONED} SELECT document_id, block_id, block_type || '-' || lpad(CAST(row_number() OVER (PARTITION BY document_id, block_type ORDER BY pos) AS VARCHAR), 3, '0') AS asset_name FROM pb WHERE block_type IN ('image', 'table', 'equation')")
def _(s, d):
    b = structure.positioned(B.blocks(s, d)).where("block_type in ('image', 'table', 'equation')")
    return b.select("document_id", "block_id", F.concat("block_type", F.lit("-"), F.lpad(F.row_number().over(W.partitionBy("document_id", "block_type").orderBy("pos")).cast("string"), 3, "0")).alias("asset_name"))


@query("q120_heading_styles", f"WITH {B.BLOCKS} SELECT CASE WHEN regexp_matches(t, '^第[一二三四五六七八九十百0-9]+[章编篇部]') THEN 'chapter' WHEN regexp_matches(t, '^第[一二三四五六七八九十百0-9]+节') THEN 'section' WHEN regexp_matches(t, '^[一二三四五六七八九十]+、') THEN 'han_numeral' WHEN regexp_matches(t, '^[（(][一二三四五六七八九十]+[）)]') THEN 'han_bracket' WHEN regexp_matches(t, '^[0-9]+(\\.[0-9]+)+') THEN 'decimal' WHEN regexp_matches(t, '^[0-9]+[.、]') THEN 'number' WHEN regexp_matches(t, '^[0-9]{{4}}年?') THEN 'year' WHEN regexp_matches(t, '^(Annex|Anexo|Annexe|Anhang)') THEN 'annex' ELSE 'plain' END AS style, count(*) AS n FROM (SELECT trim(content) AS t FROM lb WHERE block_type = 'title' AND content IS NOT NULL) GROUP BY 1")
def _(s, d):
    return B.blocks(s, d).where("block_type = 'title' and content is not null").groupBy(X.heading_style(F.trim("content")).alias("style")).agg(F.count("*").alias("n"))


@query("q125_heading_keys", f"WITH {B.BLOCKS} SELECT key, count(*) AS n, count(DISTINCT document_id) AS documents FROM (SELECT document_id, lower(regexp_replace(regexp_replace(regexp_replace(content, '[ .·…　]*[0-9]*[ ]*$', ''), '[\\s　]+', '', 'g'), '[:：。.,，;；]+$', '')) AS key FROM lb WHERE block_type = 'title' AND content IS NOT NULL) GROUP BY key")
def _(s, d):
    return B.blocks(s, d).where("block_type = 'title' and content is not null").groupBy(X.heading_key(F.col("content")).alias("key")).agg(F.count("*").alias("n"), F.count_distinct("document_id").alias("documents"))


@query("q131_table_rows", f"WITH {B.BLOCKS}, r AS (SELECT block_id, unnest(string_split(content, chr(10))) AS line FROM lb WHERE block_type = 'table' AND content IS NOT NULL) SELECT block_id, count(*) FILTER (WHERE regexp_matches(line, '^\\s*\\|.*\\|\\s*$')) AS pipe_rows, count(*) FILTER (WHERE regexp_matches(line, '^\\s*\\|(\\s*:?-{{3,}}:?\\s*\\|)+\\s*$')) AS rules, count(*) FILTER (WHERE regexp_matches(line, '<tr')) AS html_rows FROM r GROUP BY block_id")
def _(s, d):
    r = B.blocks(s, d).where("block_type = 'table' and content is not null").select("block_id", F.explode(F.split("content", "\n")).alias("line"))
    return r.groupBy("block_id").agg(F.count_if(F.col("line").rlike(r"^\s*\|.*\|\s*$")).alias("pipe_rows"), F.count_if(F.col("line").rlike(r"^\s*\|(\s*:?-{3,}:?\s*\|)+\s*$")).alias("rules"), F.count_if(F.col("line").rlike("<tr")).alias("html_rows"))


@query("q153_table_cells", f"WITH {B.BLOCKS}, c AS (SELECT block_id, unnest(regexp_extract_all(content, '<t[dh][^>]*>(.*?)</t[dh]>', 1)) AS cell FROM lb WHERE block_type = 'table' AND content IS NOT NULL) SELECT block_id, count(*) AS cells, count(*) FILTER (WHERE regexp_matches(trim(regexp_replace(cell, '<[^<>]*>', '', 'g')), '^[0-9.]+$')) AS numeric_cells, CAST(sum(length(trim(regexp_replace(cell, '<[^<>]*>', '', 'g')))) AS BIGINT) AS chars FROM c GROUP BY block_id")
def _(s, d):
    c = B.blocks(s, d).where("block_type = 'table' and content is not null").select("block_id", F.explode(F.regexp_extract_all("content", F.lit("<t[dh][^>]*>(.*?)</t[dh]>"), 1)).alias("cell"))
    c = c.withColumn("cell", F.trim(F.regexp_replace("cell", "<[^<>]*>", "")))
    return c.groupBy("block_id").agg(F.count("*").alias("cells"), F.count_if(F.col("cell").rlike("^[0-9.]+$")).alias("numeric_cells"), F.sum(F.char_length("cell")).alias("chars"))


@query("q158_fixed_chunks", f"WITH RECURSIVE {B.T0} SELECT unit_id, article_id, length(retrieval_text) AS chars, len(atoms) AS atoms, page_start, page_end, length(retrieval_text) > 1200 AS oversized, sha256(retrieval_text) AS text_hash FROM t0")
def _(s, d):
    u = units.fixed_chunks(B.atoms(s, d))
    return u.select("unit_id", "article_id", F.char_length("retrieval_text").cast("long").alias("chars"), F.size("retrieval_atoms").cast("long").alias("atoms"), "page_start", "page_end", "oversized", F.sha2("retrieval_text", 256).alias("text_hash"))


_T1 = B.ATOMS + """, m AS (SELECT *, array_to_string(coalesce(heading_path, []), ' > ') AS prefix FROM atm), i0 AS (SELECT *, CASE WHEN lag(pos) OVER w IS NOT NULL AND prefix IS NOT DISTINCT FROM lag(prefix) OVER w THEN 0 ELSE 1 END AS c FROM m WINDOW w AS (PARTITION BY article_id ORDER BY pos)),
 i1 AS (SELECT *, sum(c) OVER (PARTITION BY article_id ORDER BY pos) AS island, CASE WHEN prefix <> '' THEN length(prefix) + 2 ELSE 0 END AS charged FROM i0), """ + B.packing_sql("i1", "article_id, island", "greatest(4800 - s.charged, 1)", "pp") + """, i2 AS (SELECT i1.*, pp.g AS p FROM i1 JOIN pp ON i1.article_id = pp.article_id AND i1.island = pp.island AND i1.pos = pp.pos), """ + B.packing_sql("i2", "article_id, island, p", "greatest(600 - s.charged, 1)", "cc") + """, i3 AS (SELECT i2.*, cc.g AS ch FROM i2 JOIN cc ON i2.article_id = cc.article_id AND i2.island = cc.island AND i2.p = cc.p AND i2.pos = cc.pos)"""


@query("q159_parent_child", f"""WITH RECURSIVE {_T1}, pa AS (SELECT article_id, island, p, any_value(CASE WHEN prefix <> '' THEN prefix || chr(10) || chr(10) ELSE '' END) || string_agg(text, chr(10) || chr(10) ORDER BY pos) AS ctx, count(*) AS k FROM i3 GROUP BY 1, 2, 3),
 chd AS (SELECT article_id, island, p, ch, any_value(CASE WHEN prefix <> '' THEN prefix || chr(10) || chr(10) ELSE '' END) || string_agg(text, chr(10) || chr(10) ORDER BY pos) AS txt, count(*) AS k FROM i3 GROUP BY 1, 2, 3, 4)
 SELECT 't1-' || c.article_id || '-' || lpad(CAST(CAST(c.island AS BIGINT) AS VARCHAR), 4, '0') || '-' || lpad(CAST(c.p + 1 AS VARCHAR), 4, '0') || '-' || lpad(CAST(c.ch + 1 AS VARCHAR), 4, '0') AS unit_id, length(txt) AS child_chars, length(ctx) AS parent_chars, c.k AS child_atoms, pa.k AS parent_atoms, sha256(txt) AS child_hash FROM chd c JOIN pa ON c.article_id = pa.article_id AND c.island = pa.island AND c.p = pa.p""")
def _(s, d):
    u = units.parent_child(B.atoms(s, d))
    return u.select("unit_id", F.char_length("retrieval_text").cast("long").alias("child_chars"), F.char_length("context_text").cast("long").alias("parent_chars"), F.size("retrieval_atoms").cast("long").alias("child_atoms"), F.size("context_atoms").cast("long").alias("parent_atoms"), F.sha2("retrieval_text", 256).alias("child_hash"))


@query("q160_concept_units", f"WITH {B.ATOMS}, {B.CONCEPTS}, r AS (SELECT filename, title, body, unnest(list_distinct(source_blocks)) AS block_id FROM lc) SELECT 'c1-' || filename AS unit_id, length(concat_ws(chr(10) || chr(10), any_value(lc.title), any_value(lc.body))) AS chars, count(DISTINCT atm.atom_id) AS atoms FROM lc LEFT JOIN (SELECT filename AS f, block_id FROM r) rr ON rr.f = lc.filename LEFT JOIN atm ON atm.block_id = rr.block_id GROUP BY filename")
def _(s, d):
    u = units.concept_units(B.concepts(s, d), B.atoms(s, d))
    return u.select("unit_id", F.char_length("retrieval_text").cast("long").alias("chars"), F.size("retrieval_atoms").cast("long").alias("atoms"))


@query("q162_coverage_map", f"WITH RECURSIVE {B.T0} SELECT article_id, count(*) AS units, CAST(sum(len(atoms)) AS BIGINT) AS covered, count(*) FILTER (WHERE length(retrieval_text) > 1200) AS oversized FROM t0 GROUP BY 1")
def _(s, d):
    u = units.fixed_chunks(B.atoms(s, d))
    return u.groupBy("article_id").agg(F.count("*").alias("units"), F.sum(F.size("retrieval_atoms")).alias("covered"), F.count_if("oversized").alias("oversized"))
