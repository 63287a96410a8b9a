"""Search as served, contracts, coverage, links, placements and readiness over the corpus."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkwell.functions import segment
from inkwell.operators import claims, metrics, records, resolve, retrieval, structure
from inkwell.plans import base as B
from inkwell.plans.knowledge_queries import _EDGES, refs
from inkwell.session import checkpoint, table

Q: dict[str, tuple] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        Q[name] = (f, sql)
        return f

    return add


#: query_id, query, concept_type, source, result_limit.
SEARCHES = [("s1", "school meals", "", "", 20), ("s2", "outlook", "topic", "", 10), ("s3", "管理处", "", "", 50), ("s4", "2006 2012", "", "review", 30), ("s5", "", "entity", "", 500), ("s6", "grant the of", "", "", 0)]
_SEARCHES = "se(query_id, query, want_type, want_source, result_limit) AS (VALUES " + ", ".join(f"('{a}', '{b}', '{c}', '{d}', {e})" for a, b, c, d, e in SEARCHES) + ")"
_FIELDS = f"""{B.CONCEPTS}, {B.BLOCKS}, sc AS (SELECT filename, min(source_file) AS source FROM (SELECT filename, unnest(source_blocks) AS block_id FROM lc) JOIN lb USING (block_id) GROUP BY 1),
 fd AS (SELECT lc.filename, concept_type, coalesce(title, '') AS title, lower(coalesce(title, '')) AS a, lower(coalesce(json_extract_string(frontmatter, '$.description'), '')) AS b, lower(coalesce(source, '')) AS c, lower(coalesce(body, '')) AS d FROM lc LEFT JOIN sc USING (filename)),
 mt AS (SELECT * FROM (SELECT *, list_filter(string_split_regex(lower(trim(query)), '\\s+'), lambda w: w <> '') AS words FROM fd CROSS JOIN se) WHERE (want_type = '' OR want_type = concept_type) AND (want_source = '' OR contains(c, lower(want_source))) AND len(list_filter(words, lambda w: NOT (contains(a, w) OR contains(b, w) OR contains(c, w) OR contains(d, w)))) = 0)"""
_SCORE = "CAST(coalesce(list_sum(list_transform(words, lambda w: 8 * ((length(a) - length(replace(a, w, ''))) // length(w)) + 4 * ((length(b) - length(replace(b, w, ''))) // length(w)) + 2 * ((length(c) - length(replace(c, w, ''))) // length(w)) + (length(d) - length(replace(d, w, ''))) // length(w))), 0) AS BIGINT)"


def fields(s, d):
    c = B.concepts(s, d)
    source = c.select("filename", F.explode("source_blocks").alias("block_id")).join(B.blocks(s, d).select("block_id", "source_file"), "block_id").groupBy("filename").agg(F.min("source_file").alias("source"))
    return c.join(source, "filename", "left").select("filename", "concept_type", "title", F.get_json_object("frontmatter", "$.description").alias("description"), "source", "body")


def _search(s, d):
    asked = s.createDataFrame(SEARCHES, "query_id string, query string, concept_type string, source string, result_limit int")
    return retrieval.search_concepts(fields(s, d), asked)


@query("q095_concept_search", f"WITH {_SEARCHES}, {_FIELDS}, rk AS (SELECT query_id, filename, {_SCORE} AS score, row_number() OVER (PARTITION BY query_id ORDER BY {_SCORE} DESC, title, filename) AS rank, result_limit FROM mt) SELECT query_id, filename, score, rank FROM rk WHERE rank <= greatest(1, least(result_limit, 100))")
def _(s, d):
    return _search(s, d).select("query_id", "filename", "score", F.col("rank").cast("long"))


@query("q040_concept_filter", f"WITH {_SEARCHES}, {_FIELDS} SELECT query_id, count(*) AS total_matches FROM mt GROUP BY 1")
def _(s, d):
    return _search(s, d).groupBy("query_id").agg(F.max("total_matches").alias("total_matches"))


_HT = "list_distinct(list_filter(string_split_regex(lower(array_to_string(heading_path, ' ')), '[ \\t\\n\\r\\f]+'), lambda w: w <> ''))"


@query("q052_best_pair", f"""WITH {B.ATOMS}, ht AS (SELECT source_file, article_id, atom_id, {_HT} AS t, row_number() OVER (PARTITION BY source_file, article_id ORDER BY pos) AS k, min(article_id) OVER (PARTITION BY source_file) AS first FROM atm),
 pr AS (SELECT l.source_file, l.atom_id AS left_atom, r.atom_id AS right_atom, len(list_intersect(l.t, r.t)) AS overlap FROM ht l JOIN ht r ON l.source_file = r.source_file AND l.article_id = l.first AND r.article_id <> r.first AND l.k <= 64 AND r.k <= 16)
 SELECT source_file, left_atom, right_atom, CAST(overlap AS BIGINT) AS overlap, overlap = 0 AS unrelated FROM pr QUALIFY row_number() OVER (PARTITION BY source_file ORDER BY overlap DESC, left_atom || '|' || right_atom DESC) = 1""")
def _(s, d):
    """Per source file the best pair of atoms across documents: 64 of its first document by 16 of each other one, as the surveyed
    operator bounds them; the greatest overlap of heading words, ties to the larger ids."""
    a = B.atoms(s, d)
    t = F.array_distinct(retrieval.tokens(F.coalesce(F.array_join("heading_path", " "), F.lit(""))))
    h = a.select("source_file", "article_id", "atom_id", t.alias("t"), F.row_number().over(W.partitionBy("source_file", "article_id").orderBy("pos")).alias("k")).where("k <= 64")
    first = h.groupBy("source_file").agg(F.min("article_id").alias("first"))
    h = h.join(first, "source_file")
    left = h.where("article_id = first").select("source_file", F.col("atom_id").alias("left_atom"), F.col("t").alias("lt"))
    right = h.where("article_id <> first and k <= 16").select("source_file", F.col("atom_id").alias("right_atom"), F.col("t").alias("rt"))
    p = left.join(right, "source_file").select("source_file", "left_atom", "right_atom", F.size(F.array_intersect("lt", "rt")).cast("long").alias("overlap"))
    best = p.groupBy("source_file").agg(F.max(F.struct("overlap", F.concat_ws("|", "left_atom", "right_atom").alias("tie"), "left_atom", "right_atom")).alias("b"))
    return best.select("source_file", "b.left_atom", "b.right_atom", "b.overlap", (F.col("b.overlap") == 0).alias("unrelated"))


@query("q055_unfinished_documents", f"WITH {B.DOCUMENTS_IR}, ex AS (SELECT document_id, unnest(range(0, page_count)) AS page_idx FROM ld WHERE page_count > 0), dn AS (SELECT document_id, page_idx FROM page_results WHERE status = 'complete' AND trim(coalesce(content, '')) <> '' UNION SELECT document_id, page_idx FROM blocks) SELECT document_id, count(*) AS missing_pages, CAST(min(page_idx) AS BIGINT) AS first_missing FROM ex WHERE NOT EXISTS (SELECT 1 FROM dn WHERE dn.document_id = ex.document_id AND dn.page_idx = ex.page_idx) GROUP BY 1")
def _(s, d):
    """Documents with pages no finished record covers: where an interrupted run goes on."""
    want = B.documents_ir(s, d).where("page_count > 0").select("document_id", F.explode(F.sequence(F.lit(0), F.col("page_count") - 1)).alias("page_idx"))
    done = table(s, d, "page_results").where("status = 'complete' and trim(coalesce(content, '')) <> ''").select("document_id", "page_idx").unionByName(table(s, d, "blocks").select("document_id", "page_idx"))
    return records.anti(want, done, ["document_id", "page_idx"]).groupBy("document_id").agg(F.count("*").alias("missing_pages"), F.min("page_idx").cast("long").alias("first_missing"))


@query("q056_atom_coverage", f"WITH {B.CONCEPTS}, c AS (SELECT DISTINCT unnest(source_blocks) AS block_id FROM lc), a AS (SELECT DISTINCT block_id FROM evidence_atoms) SELECT missing_in, count(*) AS blocks, min(block_id) AS first_block FROM (SELECT block_id, 'evidence_atoms' AS missing_in FROM c WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.block_id = c.block_id) UNION ALL SELECT block_id, 'concepts' FROM a WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.block_id = a.block_id)) GROUP BY 1")
def _(s, d):
    c = B.concepts(s, d).select(F.explode("source_blocks").alias("block_id"))
    return records.two_way_audit(c, table(s, d, "evidence_atoms"), "block_id", "concepts", "evidence_atoms").groupBy("missing_in").agg(F.count("*").alias("blocks"), F.min("block_id").alias("first_block"))


_LINKS = f"""{B.CONCEPTS}, {B.BLOCKS}, nd AS (SELECT filename AS node FROM lc UNION SELECT block_id FROM lb),
 li AS (SELECT DISTINCT filename AS source, regexp_replace(m, '^.*/', '') AS target FROM (SELECT filename, unnest(list_concat(regexp_extract_all(body, '\\]\\(([^()\\s]+)\\)', 1), regexp_extract_all(body, '\\[\\[([^\\[\\]|\\s]+)(?:\\|[^\\[\\]]*)?\\]\\]', 1))) AS m FROM lc) WHERE m <> ''), eg AS (SELECT source, target FROM li WHERE target IN (SELECT node FROM nd))"""


def link_edges(s, d):
    """Distinct (source, target) of Markdown and double-bracket links to known concepts and blocks."""
    c = B.concepts(s, d)
    nodes = c.select(F.col("filename").alias("target")).unionByName(B.blocks(s, d).select(F.col("block_id").alias("target")))
    marks = F.concat(F.regexp_extract_all("body", F.lit(r"\]\(([^()\s]+)\)"), 1), F.regexp_extract_all("body", F.lit(r"\[\[([^\[\]|\s]+)(?:\|[^\[\]]*)?\]\]"), 1))
    e = c.select(F.col("filename").alias("source"), F.explode(marks).alias("m")).where("m <> ''").select("source", F.regexp_replace("m", r"^.*/", "").alias("target")).distinct()
    return e.join(nodes, "target", "left_semi")


@query("q197_link_graph", f"WITH {_LINKS} SELECT source, target FROM eg")
def _(s, d):
    return link_edges(s, d).select("source", "target")


@query("q197_graph_layout", f"WITH {_LINKS}, g AS (SELECT DISTINCT n FROM (SELECT source AS n FROM eg UNION ALL SELECT target FROM eg)), o AS (SELECT n, row_number() OVER (ORDER BY n) - 1 AS i, (SELECT count(*) FROM g) AS k FROM g) SELECT n AS node, round(500 + 260 * cos(2 * pi() * i / k), 1) AS x, round(350 + 260 * sin(2 * pi() * i / k), 1) AS y FROM o")
def _(s, d):
    e = link_edges(s, d)
    n = checkpoint(e.select(F.col("source").alias("n")).unionByName(e.select(F.col("target").alias("n"))).distinct())
    k = n.count()
    i = metrics.number_rows(n, "n", max(1, k // 50_000))
    angle = F.lit(2 * 3.141592653589793) * F.col("i") / F.lit(max(k, 1))
    return i.select(F.col("n").alias("node"), F.round(500 + 260 * F.cos(angle), 1).alias("x"), F.round(350 + 260 * F.sin(angle), 1).alias("y"))


@query("q213_run_audit", f"""WITH {B.CONCEPTS}, {B.BLOCKS}, {B.SEGMENTS}, rf AS (SELECT filename, concept_type, unnest(source_blocks) AS block_id FROM lc), cv AS (SELECT block_id, count(*) AS k FROM (SELECT unnest(block_ids) AS block_id FROM ls) GROUP BY 1)
 SELECT 'uncovered_blocks' AS rule, count(*) AS violations FROM lb LEFT JOIN cv USING (block_id) WHERE block_type NOT IN ('header', 'page_number') AND k IS NULL
 UNION ALL SELECT 'multiply_covered_blocks', count(*) FROM cv WHERE k > 1
 UNION ALL SELECT 'dangling_segment_blocks', count(*) FROM cv WHERE block_id NOT IN (SELECT block_id FROM lb)
 UNION ALL SELECT 'repeated_refs', count(*) FROM (SELECT filename, block_id FROM rf GROUP BY 1, 2 HAVING count(*) > 1)
 UNION ALL SELECT 'refs_in_several_groups', count(*) FROM (SELECT block_id FROM rf GROUP BY 1 HAVING count(DISTINCT filename) > 1)
 UNION ALL SELECT 'joint_groups_of_two_types', count(*) FROM (SELECT block_id FROM rf GROUP BY 1 HAVING count(DISTINCT concept_type) > 1)
 UNION ALL SELECT 'assets_without_path', count(*) FROM lb WHERE block_type = 'image' AND coalesce(asset_path, '') = ''
 UNION ALL SELECT 'wrong_counts', count(*) FROM ls WHERE char_count IS DISTINCT FROM length(content)""")
def _(s, d):
    """Exact cover of the blocks by segments, groups of refs, assets and recorded sizes: one row a rule."""
    b, seg = B.blocks(s, d).select("block_id", "block_type", "asset_path"), B.segments(s, d)
    rf = B.concepts(s, d).select("filename", "concept_type", F.explode("source_blocks").alias("block_id"))
    cv = seg.select(F.explode("block_ids").alias("block_id")).groupBy("block_id").agg(F.count("*").alias("k"))
    per = rf.groupBy("block_id").agg(F.count_distinct("filename").alias("f"), F.count_distinct("concept_type").alias("t"))
    rules = {
        "uncovered_blocks": records.anti(b.where("block_type not in ('header', 'page_number')"), cv, "block_id"),
        "multiply_covered_blocks": cv.where("k > 1"),
        "dangling_segment_blocks": records.anti(cv, b, "block_id"),
        "repeated_refs": rf.groupBy("filename", "block_id").count().where("count > 1"),
        "refs_in_several_groups": per.where("f > 1"),
        "joint_groups_of_two_types": per.where("t > 1"),
        "assets_without_path": b.where("block_type = 'image' and coalesce(asset_path, '') = ''"),
        "wrong_counts": seg.where(~F.col("char_count").eqNullSafe(F.char_length("content"))),
    }
    out = None
    for name, rows in rules.items():
        r = rows.agg(F.lit(name).alias("rule"), F.count("*").alias("violations"))
        out = r if out is None else out.unionByName(r)
    return out


@query("q215_readiness_audit", f"""WITH {B.CONCEPTS}, {B.DOCUMENTS_IR}, ea AS (SELECT DISTINCT article_id, block_id FROM evidence_atoms), ra AS (SELECT DISTINCT article_id FROM ea), rf AS (SELECT DISTINCT unnest(source_blocks) AS block_id FROM lc), ca AS (SELECT DISTINCT article_id FROM rf JOIN ea USING (block_id)), n AS (SELECT
 (SELECT count(*) FROM ld WHERE document_id NOT IN (SELECT article_id FROM ra)) AS uncovered_ref_sources, (SELECT count(*) FROM ld WHERE document_id NOT IN (SELECT article_id FROM ca)) AS uncovered_concept_sources,
 (SELECT count(*) FROM ra WHERE article_id NOT IN (SELECT document_id FROM ld)) AS orphan_ref_sources, (SELECT count(*) FROM ca WHERE article_id NOT IN (SELECT document_id FROM ld)) AS orphan_concept_sources,
 (SELECT count(*) FROM rf WHERE block_id NOT IN (SELECT block_id FROM ea)) AS dangling_concept_refs)
 SELECT *, CASE WHEN uncovered_ref_sources + uncovered_concept_sources + orphan_ref_sources + orphan_concept_sources + dangling_concept_refs = 0 THEN 'ready' ELSE 'incomplete' END AS status FROM n""")
def _(s, d):
    """Whether concepts and evidence cover the corpus: counts of what is uncovered, orphaned or dangling, and the status."""
    docs = B.documents_ir(s, d).select(F.col("document_id").alias("article_id"))
    ea = table(s, d, "evidence_atoms").select("article_id", "block_id").distinct()
    rf = B.concepts(s, d).select(F.explode("source_blocks").alias("block_id")).distinct()
    ra, ca = ea.select("article_id").distinct(), rf.join(ea, "block_id").select("article_id").distinct()
    sets = {"uncovered_ref_sources": (docs, ra), "uncovered_concept_sources": (docs, ca), "orphan_ref_sources": (ra, docs), "orphan_concept_sources": (ca, docs)}
    out = records.anti(rf, ea, "block_id").agg(F.count("*").alias("dangling_concept_refs"))
    for name, (x, y) in sets.items():
        out = out.join(F.broadcast(records.anti(x, y, "article_id").agg(F.count("*").alias(name))))  # one row each
    return out.withColumn("status", F.when(sum((F.col(c) for c in (*sets, "dangling_concept_refs")), F.lit(0)) == 0, "ready").otherwise("incomplete"))


#: Headings of a publication's own parts, without white space, in lower case.
PUBLICATION_PARTS = "编委会|编辑委员会|前言|序言|preface|后记|目录|版权页?|出版说明|作者简介|致谢|contents?"


@query("q038_publication_headings", rf"WITH {B.BLOCKS}, h AS (SELECT block_type, regexp_full_match(lower(regexp_replace(coalesce(content, ''), '[\s#]+', '', 'g')), '(?:{PUBLICATION_PARTS})') AS furniture FROM lb WHERE block_type IN ('title', 'header')) SELECT block_type, count(*) AS headings, count(*) FILTER (WHERE furniture) AS publication_parts FROM h GROUP BY 1")
def _(s, d):
    bare = F.lower(F.regexp_replace(F.coalesce("content", F.lit("")), r"[\s#]+", ""))
    h = B.blocks(s, d).where("block_type in ('title', 'header')").select("block_type", bare.rlike(f"^(?:{PUBLICATION_PARTS})$").alias("furniture"))
    return h.groupBy("block_type").agg(F.count("*").alias("headings"), F.count_if("furniture").alias("publication_parts"))


@query("q048_evidence_blocks", f"WITH {B.CONCEPTS}, {B.BLOCKS}, r AS (SELECT filename, unnest(source_blocks) AS block_id FROM lc) SELECT r.filename, r.block_id, lb.page_idx, CASE WHEN lb.block_id IS NULL THEN 'missing_block' WHEN NOT coalesce(lb.evidence_eligible, false) THEN 'not_eligible' WHEN trim(coalesce(lb.content, '')) = '' THEN 'empty' END AS warning FROM r LEFT JOIN lb USING (block_id)")
def _(s, d):
    """Each ref with its evidence block; a block that is missing or can't serve is a warning, not a lost row."""
    r = B.concepts(s, d).select("filename", F.explode("source_blocks").alias("block_id"))
    b = B.blocks(s, d).select("block_id", "page_idx", F.coalesce("evidence_eligible", F.lit(False)).alias("ok"), (F.trim(F.coalesce("content", F.lit(""))) == "").alias("blank"), F.lit(True).alias("hit"))
    warning = F.when(F.col("hit").isNull(), "missing_block").when(~F.col("ok"), "not_eligible").when(F.col("blank"), "empty")
    return r.join(b, "block_id", "left").select("filename", "block_id", "page_idx", warning.alias("warning"))


_SEQ = "[\\x{3400}-\\x{9fff}A-Za-z0-9]+"
_SHARED = f"""{_EDGES}, pa AS (SELECT left_ref AS current, right_ref AS target FROM ed UNION ALL SELECT right_ref, left_ref FROM ed), sq AS (SELECT filename AS target, unnest(regexp_extract_all(coalesce(title, ''), '{_SEQ}')) AS q FROM lc), gr AS (SELECT DISTINCT target, substr(q, i, n) AS phrase FROM (SELECT target, q, n, unnest(range(1, length(q) - n + 2)) AS i FROM (SELECT target, q, unnest(range(4, least(12, length(q)) + 1)) AS n FROM sq))),
 ma AS (SELECT current, pa.target, phrase FROM pa JOIN gr USING (target) JOIN lc ON lc.filename = pa.current WHERE contains(lc.body, phrase)), mx AS (SELECT * FROM ma a WHERE NOT EXISTS (SELECT 1 FROM ma b WHERE b.current = a.current AND b.target = a.target AND b.phrase <> a.phrase AND contains(b.phrase, a.phrase)))"""


def shared_phrases(s, d):
    """(current, target, phrase): substrings of 4 to 12 signs of a candidate target's title that stand in the current body, only
    those within no longer one."""
    e = resolve.candidate_edges(refs(s, d))
    pairs = e.select(F.col("left_ref").alias("current"), F.col("right_ref").alias("target")).unionByName(e.select(F.col("right_ref").alias("current"), F.col("left_ref").alias("target")))
    c = B.concepts(s, d)
    runs = F.regexp_extract_all(F.coalesce("title", F.lit("")), F.lit(f"({_SEQ})"), 1)
    grams = lambda q: F.flatten(F.transform(F.filter(F.sequence(F.lit(4), F.lit(12)), lambda n: n <= F.char_length(q)), lambda n: F.transform(F.sequence(F.lit(1), F.char_length(q) - n + 1), lambda i: q.substr(i, n))))
    g = c.select(F.col("filename").alias("target"), F.array_distinct(F.flatten(F.transform(runs, grams))).alias("g"))
    m = pairs.join(g, "target").join(c.select(F.col("filename").alias("current"), "body"), "current")
    hit = m.select("current", "target", F.filter("g", lambda p: F.col("body").contains(p)).alias("m"))
    most = F.filter("m", lambda p: ~F.exists("m", lambda o: (o != p) & o.contains(p)))
    return hit.select("current", "target", F.explode(most).alias("phrase"))


@query("q139_shared_phrases", f"WITH {_SHARED} SELECT current, target, phrase FROM mx")
def _(s, d):
    return shared_phrases(s, d)


@query("q109_unique_anchors", f"WITH {_SHARED} SELECT current, phrase, min(target) AS target FROM mx GROUP BY 1, 2 HAVING count(DISTINCT target) = 1")
def _(s, d):
    """Phrases that point to exactly one target."""
    return shared_phrases(s, d).groupBy("current", "phrase").agg(F.min("target").alias("target"), F.count_distinct("target").alias("k")).where("k = 1").drop("k")


@query("q138_free_anchors", f"""WITH {_SHARED}, un AS (SELECT current, phrase, min(target) AS target FROM mx GROUP BY 1, 2 HAVING count(DISTINCT target) = 1), po AS (SELECT current, phrase, target, strpos(body, phrase) AS a, substr(body, 1, strpos(body, phrase) - 1) AS pre, body FROM un JOIN lc ON lc.filename = un.current)
 SELECT current, phrase, target, CAST(a AS BIGINT) AS start_char, CASE WHEN len(string_split(pre, '```')) % 2 = 0 THEN 'code' WHEN len(string_split(pre, '[[')) > len(string_split(pre, ']]')) THEN 'link' WHEN regexp_matches(pre, '(^|\\n)#[^\\n]*$') THEN 'heading' END AS protected FROM po""")
def _(s, d):
    """The first place of each anchor and what protects it from being made a link: code, another link or a heading."""
    u = shared_phrases(s, d).groupBy("current", "phrase").agg(F.min("target").alias("target"), F.count_distinct("target").alias("k")).where("k = 1")
    p = u.join(B.concepts(s, d).select(F.col("filename").alias("current"), "body"), "current").withColumn("a", F.expr("instr(body, phrase)")).withColumn("pre", F.expr("substr(body, 1, a - 1)"))
    n = lambda mark: retrieval.occurrences(F.col("pre"), F.lit(mark))
    why = F.when(n("```") % 2 == 1, "code").when(n("[[") > n("]]"), "link").when(F.col("pre").rlike(r"(^|\n)#[^\n]*$"), "heading")
    return p.select("current", "phrase", "target", F.col("a").cast("long").alias("start_char"), why.alias("protected"))


@query("q114_placement_terms", f"""WITH {B.CONCEPTS}, rn AS (SELECT filename, unnest(regexp_extract_all(regexp_replace(coalesce(title, ''), '\\s+', '', 'g'), '[A-Za-z0-9]{{2,}}|[\\x{{3400}}-\\x{{9fff}}]{{2,}}')) AS r FROM lc),
 tm AS (SELECT filename, lower(r) AS t FROM rn UNION SELECT filename, substr(r, i, 2) FROM (SELECT filename, r, unnest(range(1, length(r))) AS i FROM rn WHERE regexp_matches(r, '^[\\x{{3400}}-\\x{{9fff}}]'))) SELECT filename, count(*) AS terms, string_agg(t, '|' ORDER BY t) AS joined FROM tm GROUP BY 1""")
def _(s, d):
    runs = F.regexp_extract_all(F.regexp_replace(F.coalesce("title", F.lit("")), r"\s+", ""), F.lit(r"([A-Za-z0-9]{2,}|[\x{3400}-\x{9fff}]{2,})"), 1)
    two = F.transform(F.filter("r", lambda r: r.rlike(r"^[\x{3400}-\x{9fff}]")), lambda r: F.transform(F.sequence(F.lit(1), F.char_length(r) - 1), lambda i: r.substr(i, F.lit(2))))
    t = B.concepts(s, d).select("filename", runs.alias("r")).select("filename", F.array_sort(F.array_distinct(F.concat(F.transform("r", F.lower), F.flatten(two)))).alias("t"))
    return t.where(F.size("t") > 0).select("filename", F.size("t").cast("long").alias("terms"), F.array_join("t", "|").alias("joined"))


#: Heading words and the type of concept each asks for.
REQUIRED = [("数据口径", "构建说明|指标设置|计算方式|数据来源|统计口径"), ("分析框架", "运行特征|现状|趋势|风险|问题|分析|评估"), ("政策建议", "建议|对策|行动|实施路径|工作措施")]


@query("q119_discovery_constraints", f"WITH {B.BLOCKS}, h AS (SELECT document_id, string_agg(trim(content), chr(10)) AS o, count(*) AS headings, count(*) FILTER (WHERE heading_level = 2 AND regexp_matches(trim(content), '^（[一二三四五六七八九十]+）')) AS reusable FROM lb WHERE block_type = 'title' AND content IS NOT NULL GROUP BY 1), r AS (SELECT *, " + ", ".join(f"CAST(regexp_matches(o, '{w}') AS INT) AS r{k}" for k, (_, w) in enumerate(REQUIRED)) + " FROM h) SELECT document_id, headings, concat_ws('|', " + ", ".join(f"CASE WHEN r{k} = 1 THEN '{n}' END" for k, (n, _) in enumerate(REQUIRED)) + ") AS required, CAST(greatest(1, r0 + r1 + r2, least(8, reusable)) AS BIGINT) AS minimum FROM r")
def _(s, d):
    t = B.blocks(s, d).where("block_type = 'title' and content is not null").withColumn("c", F.trim("content"))
    has = [F.max(F.col("c").rlike(w).cast("int")).alias(f"r{k}") for k, (_, w) in enumerate(REQUIRED)]
    h = t.groupBy("document_id").agg(F.count("*").alias("headings"), F.count_if((F.col("heading_level") == 2) & F.col("c").rlike("^（[一二三四五六七八九十]+）")).alias("reusable"), *has)
    return h.select("document_id", "headings", F.concat_ws("|", *[F.when(F.col(f"r{k}") == 1, n) for k, (n, _) in enumerate(REQUIRED)]).alias("required"), F.greatest(F.lit(1), F.col("r0") + F.col("r1") + F.col("r2"), F.least(F.lit(8), "reusable")).cast("long").alias("minimum"))


@query("q136_asset_preservation", f"WITH {B.BLOCKS}, {B.SEGMENTS}, a AS (SELECT block_id, content FROM lb WHERE block_type IN ('image', 'table') AND trim(coalesce(content, '')) <> ''), sg AS (SELECT DISTINCT unnest(block_ids) AS block_id, content FROM ls) SELECT a.block_id, count(sg.content) AS segments, CAST(coalesce(sum((length(sg.content) - length(replace(sg.content, trim(a.content), ''))) // length(trim(a.content))), 0) AS BIGINT) AS occurrences, CAST(coalesce(sum((length(sg.content) - length(replace(sg.content, trim(a.content), ''))) // length(trim(a.content))), 0) AS BIGINT) - count(sg.content) AS delta FROM a LEFT JOIN sg USING (block_id) GROUP BY 1")
def _(s, d):
    """Each image or table must stand in a segment as often as the segment lists it; delta is what was lost (negative) or repeated."""
    a = B.blocks(s, d).where("block_type in ('image', 'table') and trim(coalesce(content, '')) <> ''").select("block_id", F.trim("content").alias("raw"))
    seg = B.segments(s, d).select(F.explode(F.array_distinct("block_ids")).alias("block_id"), "content")
    j = a.join(seg, "block_id", "left").groupBy("block_id").agg(F.count("content").alias("segments"), F.coalesce(F.sum(retrieval.occurrences(F.col("content"), F.col("raw"))), F.lit(0).cast("long")).alias("occurrences"))
    return j.withColumn("delta", F.col("occurrences") - F.col("segments"))


@query("q147_scope_validation", f"WITH {B.ATOMS}, {B.CONCEPTS}, sc AS (SELECT DISTINCT filename, unnest(regexp_extract_all(title, '(?:19|20)[0-9]{{2}}')) AS year FROM lc), ev AS (SELECT filename, string_agg(text, chr(10)) AS t FROM (SELECT filename, unnest(list_distinct(source_blocks)) AS block_id FROM lc) JOIN atm USING (block_id) GROUP BY 1) SELECT sc.filename, year, CASE WHEN contains(coalesce(ev.t, ''), year) THEN 'kept' WHEN contains(coalesce(lc.body, ''), year) THEN 'rejected' ELSE 'dropped' END AS decision FROM sc JOIN lc USING (filename) LEFT JOIN ev USING (filename)")
def _(s, d):
    """Scope years of a concept: kept where the evidence has them, rejected where the text uses one it hasn't, else dropped."""
    c = B.concepts(s, d)
    scope = c.select("filename", "body", F.explode(F.array_distinct(F.regexp_extract_all("title", F.lit("((?:19|20)[0-9]{2})"), 1))).alias("year"))
    ev = c.select("filename", F.explode(F.array_distinct("source_blocks")).alias("block_id")).join(B.atoms(s, d).select("block_id", "text"), "block_id")
    held = scope.select("filename", "year").join(ev, "filename").groupBy("filename", "year").agg(F.max(F.col("text").contains(F.col("year"))).alias("ok"))
    decision = F.when(F.coalesce("ok", F.lit(False)), "kept").when(F.coalesce(F.col("body").contains(F.col("year")), F.lit(False)), "rejected").otherwise("dropped")
    return scope.join(held, ["filename", "year"], "left").select("filename", "year", decision.alias("decision"))


@query("q021_pixel_boxes", f"WITH {B.BLOCKS}, x AS (SELECT block_id, list_transform(bbox, lambda v: v / 1000.0::DOUBLE) AS b FROM lb WHERE bbox IS NOT NULL AND len(bbox) = 4), v AS (SELECT block_id, b, greatest(0, least(1199, round_even(b[1] * 1200, 0)::INT)) AS l, greatest(0, least(1599, round_even(b[2] * 1600, 0)::INT)) AS t FROM x WHERE len(list_filter(b, lambda z: z < 0 OR z > 1)) = 0) SELECT x.block_id, l AS left_px, t AS top_px, greatest(l + 1, least(1200, round_even(x.b[3] * 1200, 0)::INT)) AS right_px, greatest(t + 1, least(1600, round_even(x.b[4] * 1600, 0)::INT)) AS bottom_px FROM x LEFT JOIN v USING (block_id)".replace("greatest(l + 1", "CASE WHEN l IS NOT NULL THEN greatest(l + 1").replace("1200, 0)::INT)) AS right_px", "1200, 0)::INT)) END AS right_px").replace("greatest(t + 1", "CASE WHEN t IS NOT NULL THEN greatest(t + 1").replace("1600, 0)::INT)) AS bottom_px", "1600, 0)::INT)) END AS bottom_px"))
def _(s, d):
    b = B.blocks(s, d).where("bbox is not null and size(bbox) = 4").select("block_id", F.transform("bbox", lambda v: v / F.lit(1000.0)).alias("b"))
    p = b.select("block_id", claims.pixel_box(F.col("b"), F.lit(1200), F.lit(1600)).alias("p"))
    return p.select("block_id", *[F.get("p", F.lit(k)).alias(n) for k, n in enumerate(("left_px", "top_px", "right_px", "bottom_px"))])


@query("q233_quality_gate", f"WITH {B.CONCEPTS}, {B.ATOMS}, n AS (SELECT filename, count(*) AS refs, count(atm.block_id) AS held, any_value(len) AS chars FROM (SELECT filename, length(coalesce(body, '')) AS len, unnest(list_distinct(source_blocks)) AS block_id FROM lc) r LEFT JOIN atm USING (block_id) GROUP BY 1), q AS (SELECT filename, round(0.7::DOUBLE * held / refs + 0.3::DOUBLE * least(chars, 600) / 600, 6) AS score FROM n) SELECT filename, score, CASE WHEN score >= 0.8 THEN 'pass' WHEN score >= 0.5 THEN 'recompile' ELSE 'reject' END AS decision FROM q")
def _(s, d):
    """A concept's score in [0, 1] (refs held by the evidence, length) against the threshold 0.80."""
    c = B.concepts(s, d).select("filename", F.char_length(F.coalesce("body", F.lit(""))).alias("chars"), F.explode(F.array_distinct("source_blocks")).alias("block_id"))
    n = c.join(B.atoms(s, d).select("block_id", F.lit(1).alias("hit")), "block_id", "left").groupBy("filename").agg(F.count("*").alias("refs"), F.count("hit").alias("held"), F.max("chars").alias("chars"))
    q = n.select("filename", F.round(0.7 * F.col("held") / F.col("refs") + 0.3 * F.least("chars", F.lit(600)) / 600, 6).alias("score"))
    return q.withColumn("decision", F.when(F.col("score") >= 0.8, "pass").when(F.col("score") >= 0.5, "recompile").otherwise("reject"))


@query("q145_covering_windows")
def _(s, d):
    """For each fragment with recorded anomalies the shortest window of its block that holds them all."""
    f = table(s, d, "excluded_fragments").where("size(source_text_anomalies) > 0").select("fragment_id", "block_id", "source_text_anomalies").dropDuplicates(["fragment_id"])
    j = f.join(B.blocks(s, d).select("block_id", "content"), "block_id").where("content is not null")
    return j.select("fragment_id", segment.covering_window(F.col("content"), F.col("source_text_anomalies")).alias("window"))


@query("q146_common_fragments")
def _(s, d):
    """The longest text of 20 signs and more that a fragment has in common with its block."""
    f = table(s, d, "excluded_fragments").where("text is not null").select("fragment_id", "block_id", "text").dropDuplicates(["fragment_id"])
    j = f.join(B.blocks(s, d).select("block_id", "content"), "block_id").where("content is not null")
    return j.select("fragment_id", segment.common_stretch(F.col("content"), F.col("text")).alias("fragment"))


_NUM = "([0-9]+(?:[.,][0-9]+)*)"
_EV = "ev AS (SELECT filename, string_agg(text, chr(10)) AS t FROM (SELECT filename, unnest(list_distinct(source_blocks)) AS block_id FROM lc) JOIN atm USING (block_id) GROUP BY 1)"
_CITED = r"\[\[(blk-[0-9a-f]+)\]\]"
_CITE = "ct AS (SELECT filename, unnest(regexp_extract_all(body, '\\[\\[(blk-[0-9a-f]+)\\]\\]', 1)) AS block_id FROM lc), cs AS (SELECT filename, count(*) AS cited, count(a.block_id) AS valid FROM ct LEFT JOIN (SELECT DISTINCT block_id FROM evidence_atoms) a USING (block_id) GROUP BY 1)"


def citations(s, d):
    """(filename, cited, valid): blocks a body cites, and those of them that are evidence."""
    c = B.concepts(s, d).select("filename", F.explode(F.regexp_extract_all("body", F.lit(_CITED), 1)).alias("block_id"))
    known = table(s, d, "evidence_atoms").select("block_id").distinct().withColumn("hit", F.lit(1))
    return c.join(known, "block_id", "left").groupBy("filename").agg(F.count("*").alias("cited"), F.count("hit").alias("valid"))


@query("q182_provisional_scores", f"WITH {B.CONCEPTS}, {_CITE} SELECT filename AS question_id, (coalesce(len(source_blocks), 0) > 0) = (trim(coalesce(body, '')) <> '') AS answerability_ok, CASE WHEN cited > 0 THEN round(valid / cited, 6) WHEN coalesce(len(source_blocks), 0) > 0 THEN 0.0 ELSE 1.0 END AS citation_validity, CAST(NULL AS DOUBLE) AS fact_recall, CAST(NULL AS BOOLEAN) AS correct FROM lc LEFT JOIN cs USING (filename)")
def _(s, d):
    """Only what needs no reading is scored: answerability and citations; semantic fields are null until they are aligned."""
    j = B.concepts(s, d).select("filename", F.coalesce(F.size("source_blocks") > 0, F.lit(False)).alias("answerable"), (F.trim(F.coalesce("body", F.lit(""))) != "").alias("answered")).join(citations(s, d), "filename", "left")
    validity = F.when(F.col("cited") > 0, F.round(F.col("valid") / F.col("cited"), 6)).when(F.col("answerable"), 0.0).otherwise(1.0)
    return j.select(F.col("filename").alias("question_id"), (F.col("answerable") == F.col("answered")).alias("answerability_ok"), validity.alias("citation_validity"), F.lit(None).cast("double").alias("fact_recall"), F.lit(None).cast("boolean").alias("correct"))


@query("q187_answer_contract", f"WITH {B.CONCEPTS}, {_CITE} SELECT filename, CASE WHEN trim(coalesce(body, '')) = '' AND coalesce(len(source_blocks), 0) > 0 THEN 'refusal_with_evidence' WHEN trim(coalesce(body, '')) <> '' AND coalesce(cited, 0) = 0 THEN 'answer_without_citation' WHEN cited > valid THEN 'unknown_citation' ELSE 'ok' END AS verdict FROM lc LEFT JOIN cs USING (filename)")
def _(s, d):
    j = B.concepts(s, d).select("filename", F.coalesce(F.size("source_blocks") > 0, F.lit(False)).alias("evidence"), (F.trim(F.coalesce("body", F.lit(""))) == "").alias("refused")).join(citations(s, d), "filename", "left")
    v = F.when(F.col("refused") & F.col("evidence"), "refusal_with_evidence").when(~F.col("refused") & (F.coalesce("cited", F.lit(0)) == 0), "answer_without_citation").when(F.col("cited") > F.col("valid"), "unknown_citation").otherwise("ok")
    return j.select("filename", v.alias("verdict"))


@query("q209_claim_contract", f"""WITH {B.ATOMS}, {B.CONCEPTS}, {_EV}, cl AS (SELECT filename, trim(unnest(string_split(coalesce(body, ''), chr(10)))) AS claim FROM lc), c2 AS (SELECT * FROM cl WHERE claim <> '' AND NOT regexp_matches(claim, '^#')),
 ch AS (SELECT filename, count(*) AS claims, count(*) FILTER (WHERE len(list_filter(regexp_extract_all(claim, '{_NUM}', 1), lambda n: NOT contains(coalesce(ev.t, ''), n))) > 0) AS unanchored FROM c2 LEFT JOIN ev USING (filename) GROUP BY 1)
 SELECT lc.filename, coalesce(claims, 0) AS claims, coalesce(unanchored, 0) AS unanchored, coalesce(claims, 0) > 8 AS too_many, coalesce(len(source_blocks), 0) <> coalesce(len(list_distinct(source_blocks)), 0) AS repeated_unit, CASE WHEN ev.t IS NULL THEN 'no_evidence' WHEN coalesce(claims, 0) > 8 OR coalesce(len(source_blocks), 0) <> coalesce(len(list_distinct(source_blocks)), 0) THEN 'broken' WHEN unanchored > 0 THEN 'unanchored' ELSE 'ok' END AS verdict FROM lc LEFT JOIN ch USING (filename) LEFT JOIN ev USING (filename)""")
def _(s, d):
    """Per bundle of claims (the lines of a body): eight at most, each unit once, every number of a claim in the evidence."""
    c = B.concepts(s, d)
    ev = c.select("filename", F.explode(F.array_distinct("source_blocks")).alias("block_id")).join(B.atoms(s, d).select("block_id", "text"), "block_id").groupBy("filename").agg(F.array_join(F.collect_list("text"), "\n").alias("t"))
    lines = F.filter(F.transform(F.split(F.coalesce("body", F.lit("")), "\n"), lambda x: F.trim(x)), lambda x: (x != "") & ~x.startswith("#"))
    j = c.select("filename", lines.alias("claims"), F.coalesce(F.size("source_blocks"), F.lit(0)).alias("units"), F.coalesce(F.size(F.array_distinct("source_blocks")), F.lit(0)).alias("distinct_units")).join(ev, "filename", "left")
    loose = F.filter("claims", lambda x: F.exists(F.regexp_extract_all(x, F.lit(_NUM), 1), lambda n: ~F.coalesce(F.col("t"), F.lit("")).contains(n)))
    r = j.select("filename", F.size("claims").cast("long").alias("claims"), F.size(loose).cast("long").alias("unanchored"), (F.col("units") != F.col("distinct_units")).alias("repeated_unit"), F.col("t").isNull().alias("bare"))
    verdict = F.when(F.col("bare"), "no_evidence").when((F.col("claims") > 8) | F.col("repeated_unit"), "broken").when(F.col("unanchored") > 0, "unanchored").otherwise("ok")
    return r.select("filename", "claims", "unanchored", (F.col("claims") > 8).alias("too_many"), "repeated_unit", verdict.alias("verdict"))


@query("q210_claim_coverage", f"WITH {B.ATOMS}, {B.CONCEPTS}, u AS (SELECT DISTINCT filename, body, unnest(source_blocks) AS block_id FROM lc), n AS (SELECT filename, u.block_id, body, list_distinct(regexp_extract_all(text, '{_NUM}', 1)) AS nums FROM u JOIN atm USING (block_id)) SELECT filename, block_id, CAST(len(nums) AS BIGINT) AS anchors, CAST(len(list_filter(nums, lambda x: contains(coalesce(body, ''), x))) AS BIGINT) AS covered, CASE WHEN len(nums) = 0 THEN 'no_anchor' WHEN len(list_filter(nums, lambda x: contains(coalesce(body, ''), x))) = len(nums) THEN 'supported' WHEN len(list_filter(nums, lambda x: contains(coalesce(body, ''), x))) > 0 THEN 'partial' ELSE 'uncovered' END AS status FROM n")
def _(s, d):
    """Each evidence unit of a concept exactly once: how many of its numbers the text takes up."""
    u = B.concepts(s, d).select("filename", "body", F.explode(F.array_distinct("source_blocks")).alias("block_id")).join(B.atoms(s, d).select("block_id", "text"), "block_id")
    nums = F.array_distinct(F.regexp_extract_all("text", F.lit(_NUM), 1))
    n = u.select("filename", "block_id", nums.alias("nums"), F.coalesce("body", F.lit("")).alias("body"))
    n = n.select("filename", "block_id", F.size("nums").cast("long").alias("anchors"), F.size(F.filter("nums", lambda x: F.col("body").contains(x))).cast("long").alias("covered"))
    return n.withColumn("status", F.when(F.col("anchors") == 0, "no_anchor").when(F.col("covered") == F.col("anchors"), "supported").when(F.col("covered") > 0, "partial").otherwise("uncovered"))


@query("q212_materialization_gates", f"""WITH {B.ATOMS}, {B.CONCEPTS}, r AS (SELECT filename, unnest(source_blocks) AS block_id FROM lc) SELECT 'title' AS gate, count(*) FILTER (WHERE trim(coalesce(title, '')) = '') AS failed, count(*) AS checked FROM lc
 UNION ALL SELECT 'body', count(*) FILTER (WHERE trim(coalesce(body, '')) = ''), count(*) FROM lc UNION ALL SELECT 'type', count(*) FILTER (WHERE coalesce(concept_type, '') NOT IN ('topic', 'entity', 'proposition', 'method')), count(*) FROM lc
 UNION ALL SELECT 'evidence', count(*) FILTER (WHERE coalesce(len(source_blocks), 0) = 0), count(*) FROM lc UNION ALL SELECT 'refs_are_atoms', count(*) FILTER (WHERE block_id NOT IN (SELECT block_id FROM atm)), count(*) FROM r
 UNION ALL SELECT 'frontmatter_title', count(*) FILTER (WHERE frontmatter IS NOT NULL AND json_extract_string(frontmatter, '$.title') IS DISTINCT FROM title), count(*) FROM lc""")
def _(s, d):
    """What a concept must have before it becomes a unit: one row a gate."""
    c = B.concepts(s, d)
    blank = lambda x: F.trim(F.coalesce(x, F.lit(""))) == ""
    gates = {"title": blank("title"), "body": blank("body"), "type": ~F.coalesce("concept_type", F.lit("")).isin("topic", "entity", "proposition", "method"), "evidence": F.coalesce(F.size("source_blocks"), F.lit(0)) <= 0,
             "frontmatter_title": F.col("frontmatter").isNotNull() & ~F.get_json_object("frontmatter", "$.title").eqNullSafe(F.col("title"))}
    failed = c.agg(F.count("*").alias("checked"), *[F.count_if(g).alias(n) for n, g in gates.items()])
    rows = failed.select(F.explode(F.array(*[F.struct(F.lit(n).alias("gate"), F.col(n).alias("failed"), F.col("checked").alias("checked")) for n in gates])).alias("x")).select("x.*")
    r = c.select(F.explode("source_blocks").alias("block_id")).join(B.atoms(s, d).select("block_id", F.lit(1).alias("hit")), "block_id", "left")
    return rows.unionByName(r.agg(F.lit("refs_are_atoms").alias("gate"), F.count_if(F.col("hit").isNull()).alias("failed"), F.count("*").alias("checked")))


@query("q214_release_audit", f"WITH {_LINKS}, l AS (SELECT source AS filename, count(*) AS links, count(*) FILTER (WHERE target IN (SELECT node FROM nd)) AS known FROM li GROUP BY 1), f AS (SELECT concept_type, filename, sha256(coalesce(body, '')) AS h, coalesce(links, 0) AS links, coalesce(known, 0) AS known FROM lc LEFT JOIN l USING (filename)) SELECT concept_type, count(*) AS files, CAST(sum(links) AS BIGINT) AS links, CAST(sum(known) AS BIGINT) AS known_links, count(DISTINCT h) AS distinct_bodies, min(h) AS first_checksum FROM f GROUP BY 1")
def _(s, d):
    c = B.concepts(s, d)
    marks = F.concat(F.regexp_extract_all("body", F.lit(r"\]\(([^()\s]+)\)"), 1), F.regexp_extract_all("body", F.lit(r"\[\[([^\[\]|\s]+)(?:\|[^\[\]]*)?\]\]"), 1))
    links = c.select("filename", F.explode(marks).alias("m")).where("m <> ''").select("filename", F.regexp_replace("m", r"^.*/", "").alias("target")).distinct().groupBy("filename").agg(F.count("*").alias("links"))
    known = link_edges(s, d).groupBy(F.col("source").alias("filename")).agg(F.count("*").alias("known"))
    f = c.select("concept_type", "filename", F.sha2(F.coalesce("body", F.lit("")), 256).alias("h")).join(links, "filename", "left").join(known, "filename", "left")
    return f.groupBy("concept_type").agg(F.count("*").alias("files"), F.coalesce(F.sum("links"), F.lit(0)).alias("links"), F.coalesce(F.sum("known"), F.lit(0)).alias("known_links"), F.count_distinct("h").alias("distinct_bodies"), F.min("h").alias("first_checksum"))


@query("q234_placement_plan", f"WITH {B.POSITIONED}, a AS (SELECT block_id, document_id, block_type, last_value(CASE WHEN block_type = 'text' THEN block_id END IGNORE NULLS) OVER (PARTITION BY document_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS anchor FROM pb), p AS (SELECT a.document_id, a.block_id, a.anchor, (SELECT count(*) FROM evidence_atoms e WHERE e.block_id = a.anchor) AS cataloged FROM a WHERE block_type IN ('image', 'table')) SELECT document_id, count(*) AS assets, count(DISTINCT block_id) AS placed_once, count(*) FILTER (WHERE anchor IS NULL) AS at_top, count(*) FILTER (WHERE anchor IS NOT NULL AND cataloged = 0) AS uncataloged FROM p GROUP BY 1")
def _(s, d):
    """Every asset exactly once, on an anchor the catalog has: counts per document."""
    b = structure.positioned(B.blocks(s, d))
    a = F.last(F.when(F.col("block_type") == "text", F.col("block_id")), ignorenulls=True).over(W.partitionBy("document_id").orderBy("pos").rowsBetween(W.unboundedPreceding, -1))
    p = b.select("document_id", "block_id", "block_type", a.alias("anchor")).where("block_type in ('image', 'table')")
    known = table(s, d, "evidence_atoms").select(F.col("block_id").alias("anchor")).distinct().withColumn("hit", F.lit(1))
    return p.join(known, "anchor", "left").groupBy("document_id").agg(F.count("*").alias("assets"), F.count_distinct("block_id").alias("placed_once"), F.count_if(F.col("anchor").isNull()).alias("at_top"), F.count_if(F.col("anchor").isNotNull() & F.col("hit").isNull()).alias("uncataloged"))


@query("q235_relation_audit", f"""WITH {_SHARED}, un AS (SELECT current, phrase, min(target) AS target FROM mx GROUP BY 1, 2 HAVING count(DISTINCT target) = 1), po AS (SELECT current, phrase, target, strpos(body, phrase) AS a, length(phrase) AS n FROM un JOIN lc ON lc.filename = un.current), kq AS (SELECT *, coalesce(a > max(a + n - 1) OVER (PARTITION BY current ORDER BY a, n DESC, phrase ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS free FROM po)
 SELECT lc.filename, count(kq.phrase) AS anchors, count(kq.phrase) FILTER (WHERE free) AS links, CASE WHEN count(kq.phrase) FILTER (WHERE free) > 0 THEN 'links' ELSE 'no_links' END AS verdict FROM lc LEFT JOIN kq ON kq.current = lc.filename GROUP BY 1""")
def _(s, d):
    """Per concept its anchors without those that overlap an earlier one, or no_links."""
    u = shared_phrases(s, d).groupBy("current", "phrase").agg(F.min("target").alias("target"), F.count_distinct("target").alias("k")).where("k = 1")
    c = B.concepts(s, d).select("filename", "body")
    p = u.join(c.withColumnRenamed("filename", "current"), "current").select("current", "phrase", F.expr("instr(body, phrase)").alias("a"), F.char_length("phrase").alias("n"))
    before = W.partitionBy("current").orderBy("a", F.desc("n"), "phrase").rowsBetween(W.unboundedPreceding, -1)
    p = p.withColumn("free", F.coalesce(F.col("a") > F.max(F.col("a") + F.col("n") - 1).over(before), F.lit(True)))
    g = p.groupBy(F.col("current").alias("filename")).agg(F.count("*").alias("anchors"), F.count_if("free").alias("links"))
    j = c.select("filename").join(g, "filename", "left").fillna(0, ["anchors", "links"])
    return j.withColumn("verdict", F.when(F.col("links") > 0, "links").otherwise("no_links"))


_TABLES = ("blocks", "page_results", "evidence_atoms", "article_segments", "concept_documents", "document_ir")
_KEYS = {"blocks": "block_id", "page_results": "record_id", "evidence_atoms": "atom_id", "article_segments": "segment_id", "concept_documents": "filename", "document_ir": "document_id"}


@query("q238_readiness_report", " UNION ALL ".join(f"SELECT '{t}' AS input, count(*) AS rows, count(DISTINCT {_KEYS[t]}) AS keys, count(*) FILTER (WHERE {_KEYS[t]} IS NULL) AS null_keys, CASE WHEN count(*) = 0 THEN 'missing' WHEN count(*) FILTER (WHERE {_KEYS[t]} IS NULL) > 0 THEN 'broken' WHEN count(*) > count(DISTINCT {_KEYS[t]}) THEN 'repeated' ELSE 'ready' END AS state FROM {t}" for t in _TABLES))
def _(s, d):
    """Reads the inputs and writes nothing: rows, keys and whether each table can be used."""
    out = None
    for t in _TABLES:
        k = F.col(_KEYS[t])
        r = table(s, d, t).agg(F.lit(t).alias("input"), F.count("*").alias("rows"), F.count_distinct(k).alias("keys"), F.count_if(k.isNull()).alias("null_keys"))
        out = r if out is None else out.unionByName(r)
    return out.withColumn("state", F.when(F.col("rows") == 0, "missing").when(F.col("null_keys") > 0, "broken").when(F.col("rows") > F.col("keys"), "repeated").otherwise("ready"))


_RUNS = f"{B.BLOCKS}, h AS (SELECT source_file, document_id, substr(sha256(document_id), 1, 1) AS x, sha256(string_agg(block_id, ',' ORDER BY block_id)) AS shape, sha256(string_agg(block_id || ':' || sha256(coalesce(content, '')), ',' ORDER BY block_id)) AS body FROM lb GROUP BY 1, 2), st AS (SELECT document_id, shape || CASE WHEN x < '3' THEN 'x' ELSE '' END AS shape, body || CASE WHEN x < '6' THEN 'x' ELSE '' END AS body FROM h WHERE x < 'e')"


def runs(s, d):
    """A document's fingerprints now, and those of a baseline run in which some documents had another shape or other texts, and
    some were absent."""
    g = B.blocks(s, d).groupBy("source_file", "document_id").agg(F.array_sort(F.collect_list(F.struct("block_id", F.sha2(F.coalesce("content", F.lit("")), 256).alias("c")))).alias("b"))
    join = lambda f: F.sha2(F.array_join(F.transform("b", f), ","), 256)
    now = g.select("source_file", "document_id", F.substring(F.sha2("document_id", 256), 1, 1).alias("x"), join(lambda b: b["block_id"]).alias("shape"), join(lambda b: F.concat(b["block_id"], F.lit(":"), b["c"])).alias("body"))
    other = lambda c, upto: F.concat(c, F.when(F.col("x") < upto, "x").otherwise(""))
    return now, now.where("x < 'e'").select("document_id", other("shape", "3").alias("old_shape"), other("body", "6").alias("old_body"))


@query("q202_update_seed", f"WITH {_RUNS} SELECT h.document_id, h.body AS fingerprint FROM h JOIN st ON st.document_id = h.document_id AND st.shape = h.shape AND st.body = h.body")
def _(s, d):
    """What a new run copies from its baseline: documents whose shape and texts are unchanged."""
    now, old = runs(s, d)
    return now.join(old, "document_id").where("shape = old_shape and body = old_body").select("document_id", F.col("body").alias("fingerprint"))


@query("q204_incremental_plan", f"WITH {_RUNS} SELECT source_file, CASE WHEN st.document_id IS NULL THEN 'discover_new' WHEN st.shape <> h.shape THEN 'discover' WHEN st.body <> h.body THEN 'concepts' ELSE 'reuse' END AS stage, count(*) AS documents FROM h LEFT JOIN st USING (document_id) GROUP BY 1, 2")
def _(s, d):
    """The first stage each document must run again: discovery if its blocks changed, concepts if only texts did."""
    now, old = runs(s, d)
    stage = F.when(F.col("old_shape").isNull(), "discover_new").when(F.col("old_shape") != F.col("shape"), "discover").when(F.col("old_body") != F.col("body"), "concepts").otherwise("reuse")
    return now.join(old, "document_id", "left").groupBy("source_file", stage.alias("stage")).agg(F.count("*").alias("documents"))


@query("q189_ref_states", f"WITH {_EDGES} SELECT ref_id, CASE WHEN EXISTS (SELECT 1 FROM ed WHERE left_ref = ref_id OR right_ref = ref_id) THEN 'candidates' ELSE 'no_candidate' END AS state FROM rf")
def _(s, d):
    r = refs(s, d)
    e = resolve.candidate_edges(r)
    with_any = e.select(F.col("left_ref").alias("ref_id")).unionByName(e.select(F.col("right_ref").alias("ref_id"))).distinct().withColumn("hit", F.lit(1))
    return r.select("ref_id").join(with_any, "ref_id", "left").select("ref_id", F.when(F.col("hit") == 1, "candidates").otherwise("no_candidate").alias("state"))


@query("q183_joint_success", f"WITH {B.CONCEPTS}, {_CITE}, rf AS (SELECT filename, count(*) AS refs, count(a.block_id) AS held, count(c.block_id) AS cited FROM (SELECT filename, unnest(list_distinct(source_blocks)) AS block_id FROM lc) r LEFT JOIN (SELECT DISTINCT block_id FROM evidence_atoms) a USING (block_id) LEFT JOIN (SELECT DISTINCT filename, block_id FROM ct) c USING (filename, block_id) GROUP BY 1) SELECT filename AS question_id, CASE WHEN trim(coalesce(body, '')) <> '' THEN coalesce(refs = held, false) AND coalesce(refs = rf.cited, false) AND coalesce(valid::DOUBLE / nullif(cs.cited, 0), 0) = 1 END AS success FROM lc LEFT JOIN rf USING (filename) LEFT JOIN cs USING (filename)")
def _(s, d):
    """Retrieved whole, cited whole and validly; null where there is no answer to judge. A given answer stands for a correct one."""
    c = B.concepts(s, d)
    known = table(s, d, "evidence_atoms").select("block_id").distinct().withColumn("hit", F.lit(1))
    marks = c.select("filename", F.explode(F.array_distinct(F.regexp_extract_all("body", F.lit(_CITED), 1))).alias("block_id")).withColumn("cite", F.lit(1))
    rf = c.select("filename", F.explode(F.array_distinct("source_blocks")).alias("block_id")).join(known, "block_id", "left").join(marks, ["filename", "block_id"], "left").groupBy("filename").agg(F.count("*").alias("refs"), F.count("hit").alias("held"), F.count("cite").alias("n"))
    answers = c.select(F.col("filename").alias("question_id"), F.when(F.trim(F.coalesce("body", F.lit(""))) != "", F.lit(True)).alias("correct"))
    retrieved = rf.select(F.col("filename").alias("question_id"), (F.col("refs") == F.col("held")).cast("int").alias("complete"))
    cited = rf.join(citations(s, d), "filename", "left").select(F.col("filename").alias("question_id"), (F.col("valid") / F.col("cited")).alias("validity"), (F.col("refs") == F.col("n")).alias("complete"))
    return claims.joint_success(answers, retrieved, cited)


@query("q156_rendered_labels", f"WITH {B.CONCEPTS} SELECT filename, 'Concept ' || coalesce(title, '') || ' (' || coalesce(concept_type, '') || ', ' || coalesce(CAST(len(source_blocks) AS VARCHAR), '') || ' sources)' AS label FROM lc")
def _(s, d):
    values = {"title": F.col("title"), "kind": F.col("concept_type"), "n": F.size("source_blocks")}
    return B.concepts(s, d).select("filename", claims.render("Concept {title} ({kind}, {n} sources)", values).alias("label"))


@query("q112_dictionary_tokens")
def _(s, d):
    """Tokens of concept titles over a dictionary frozen from the places and bodies of the corpus' commonest headings."""
    words = [r[0] for r in B.blocks(s, d).where("block_type = 'title'").select(F.explode(F.regexp_extract_all("content", F.lit(r"([\x{3400}-\x{9fff}]{2,4})"), 1)).alias("w")).groupBy("w").count().orderBy(F.desc("count"), "w").limit(5_000).select("w").collect()]
    return B.concepts(s, d).where("title is not null").select("filename", F.array_join(segment.dictionary_tokens(words)(F.col("title")), "|").alias("tokens"))
