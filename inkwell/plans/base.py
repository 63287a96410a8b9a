"""Shared beginnings of the queries: latest deliveries, atoms, questions; in Spark and as SQL for the comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.operators import units
from inkwell.operators.records import latest
from inkwell.session import table


def blocks(spark: SparkSession, d: str) -> DataFrame:
    return latest(table(spark, d, "blocks"), "block_id", "loaded_at")


def pages(spark: SparkSession, d: str) -> DataFrame:
    return latest(table(spark, d, "page_results"), "record_id", "recorded_at")


def concepts(spark: SparkSession, d: str) -> DataFrame:
    return latest(table(spark, d, "concept_documents"), "filename", "compiled_at")


def documents_ir(spark: SparkSession, d: str) -> DataFrame:
    return latest(table(spark, d, "document_ir"), "document_id", "processed_at")


def segments(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "article_segments").dropDuplicates(["segment_id"])


def atoms(spark: SparkSession, d: str) -> DataFrame:
    return units.atoms(blocks(spark, d))


def questions(spark: SparkSession, d: str) -> DataFrame:
    """Every concept's title is a question; its source blocks are the gold evidence."""
    return concepts(spark, d).where("title is not null").select(F.col("filename").alias("question_id"), F.col("title").alias("question"))


def gold(spark: SparkSession, d: str) -> DataFrame:
    a = atoms(spark, d).select("block_id", "atom_id")
    c = concepts(spark, d).where("title is not null").select(F.col("filename").alias("question_id"), F.explode(F.array_distinct("source_blocks")).alias("block_id"))
    return c.join(a, "block_id").select("question_id", F.lit(1).alias("set_id"), "atom_id")


BLOCKS = "lb AS (SELECT * FROM blocks QUALIFY row_number() OVER (PARTITION BY block_id ORDER BY loaded_at DESC NULLS LAST) = 1)"
PAGES = "lp AS (SELECT * FROM page_results QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY recorded_at DESC NULLS LAST) = 1)"
CONCEPTS = "lc AS (SELECT * FROM concept_documents QUALIFY row_number() OVER (PARTITION BY filename ORDER BY compiled_at DESC NULLS LAST) = 1)"
DOCUMENTS_IR = "ld AS (SELECT * FROM document_ir QUALIFY row_number() OVER (PARTITION BY document_id ORDER BY processed_at DESC NULLS LAST) = 1)"
SEGMENTS = "ls AS (SELECT * FROM article_segments QUALIFY row_number() OVER (PARTITION BY segment_id) = 1)"
POSITIONED = BLOCKS + ", pb AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY page_idx NULLS LAST, reading_order NULLS LAST, block_id) AS pos FROM lb)"
ATOMS = POSITIONED + r""", atm AS (SELECT document_id || ':p' || lpad(CAST(page_idx + 1 AS VARCHAR), 3, '0') || ':b' || block_id AS atom_id,
 document_id AS article_id, source_file, page_idx + 1 AS page, block_id, block_type, heading_path, txt AS text, pos, length(txt) AS n
 FROM (SELECT *, regexp_replace(content, '^[ \t\n\r\f]+|[ \t\n\r\f]+$', '', 'g') AS txt FROM pb) WHERE evidence_eligible AND txt <> '' AND page_idx >= 0)"""
TITLED = POSITIONED + ", tb AS (SELECT *, CASE WHEN block_type = 'title' THEN CASE WHEN heading_level BETWEEN 1 AND 6 THEN heading_level ELSE 1 END END AS level FROM pb)"


def packing_sql(source: str, part: str, limit: str, name: str) -> str:
    """The greedy fold as a recursive CTE over rows numbered within their part: columns of ``part``, pos, n; adds g."""
    keys = [k.strip() for k in part.split(",")]
    match = " AND ".join(f"s.{k} = p.{k}" for k in keys)
    return f"""{name}_s AS (SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY pos) AS rn FROM {source}),
{name} AS (SELECT {part}, pos, rn, n AS used, 0 AS g FROM {name}_s WHERE rn = 1
 UNION ALL SELECT {', '.join('s.' + k for k in keys)}, s.pos, s.rn, CASE WHEN p.used + s.n + 2 > {limit} THEN s.n ELSE p.used + s.n + 2 END,
 CASE WHEN p.used + s.n + 2 > {limit} THEN p.g + 1 ELSE p.g END FROM {name} p JOIN {name}_s s ON {match} AND s.rn = p.rn + 1)"""


T0 = ATOMS + ", " + packing_sql("atm", "article_id", "1200", "f") + """, t0 AS (SELECT 't0-' || atm.article_id || '-' || lpad(CAST(g + 1 AS VARCHAR), 5, '0') AS unit_id, atm.article_id,
 string_agg(text, chr(10) || chr(10) ORDER BY atm.pos) AS retrieval_text, list(atom_id ORDER BY atm.pos) AS atoms, min(page) AS page_start, max(page) AS page_end FROM atm JOIN f ON atm.article_id = f.article_id AND atm.pos = f.pos GROUP BY atm.article_id, g)"""
QUESTIONS = CONCEPTS + ", qu AS (SELECT filename AS question_id, title AS question FROM lc WHERE title IS NOT NULL)"
TOKENS = r"list_filter(string_split_regex(lower({}), '[ \t\n\r\f]+'), lambda w: w <> '')"
BM25 = """po AS (SELECT unit_id, term, count(*) AS tf, any_value(dl) AS dl FROM (SELECT unit_id, unnest(t) AS term, len(t) AS dl FROM (SELECT unit_id, """ + TOKENS.format("retrieval_text") + """ AS t FROM t0)) GROUP BY unit_id, term),
st AS (SELECT count(*) AS units, avg(dl) AS avgdl FROM (SELECT DISTINCT unit_id, dl FROM po)),
aq AS (SELECT question_id, term, count(*) AS qf FROM (SELECT question_id, unnest(""" + TOKENS.format("question") + """) AS term FROM qu) GROUP BY question_id, term),
dff AS (SELECT term, count(*) AS df FROM po GROUP BY term),
bm AS (SELECT question_id, unit_id, sum(qf * ln(1 + (units - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.5::DOUBLE / (tf + 1.5::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / avgdl))) AS score FROM po JOIN aq USING (term) JOIN dff USING (term) CROSS JOIN st GROUP BY question_id, unit_id)"""
