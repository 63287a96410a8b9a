"""Document structure over ordered blocks: levels, stacks, islands, extents, roles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

LEVELS = range(1, 7)
#: Titles that name no document, lower case.
GENERIC = ("contents", "table of contents", "abstract", "introduction", "foreword", "preface", "annex", "references", "目录", "前言", "摘要")


def positioned(blocks: DataFrame) -> DataFrame:
    """Blocks with ``pos``, their place in the document from 1: by page, reading order and id."""
    return blocks.withColumn("pos", F.row_number().over(W.partitionBy("document_id").orderBy(F.asc_nulls_last("page_idx"), F.asc_nulls_last("reading_order"), "block_id")))


def heading_level(level: Column, kind: Column) -> Column:
    """A level within 1 to 6, else 1 for titles, else null."""
    return F.when(level.between(1, 6), level).when(kind == "title", F.lit(1))


def heading_stack(blocks: DataFrame) -> DataFrame:
    """The running heading path of every block: for each level the last title of it that no higher title has ended since.

    Windows only; no fold and no state beside six positions."""
    b = positioned(blocks).withColumn("level", F.when(F.col("block_type") == "title", heading_level(F.col("heading_level"), F.col("block_type"))))
    upto = W.partitionBy("document_id").orderBy("pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    for n in LEVELS:
        mine = F.when(F.col("level") == n, F.struct("pos", F.trim(F.coalesce("content", F.lit(""))).alias("title")))
        b = b.withColumn(f"_h{n}", F.max(mine).over(upto))
    kept = []
    for n in LEVELS:
        above = [F.coalesce(F.col(f"_h{m}.pos"), F.lit(0)) for m in LEVELS if m < n]
        alive = F.col(f"_h{n}.pos") > (F.greatest(*above) if len(above) > 1 else above[0] if above else F.lit(0))
        kept.append(F.when(alive, F.col(f"_h{n}.title")))
    path = F.filter(F.array(*kept), lambda t: t.isNotNull())
    return b.withColumn("running_path", path).drop(*[f"_h{n}" for n in LEVELS])


def islands(rows: DataFrame, same: Column, part: list[str], order: list[str]) -> DataFrame:
    """``island``: a number for each run of equal ``same`` values in order."""
    w = W.partitionBy(*part).orderBy(*order)
    changed = F.when(same.eqNullSafe(F.lag(same).over(w)) & F.lag(F.lit(1)).over(w).isNotNull(), 0).otherwise(1)
    return rows.withColumn("_c", changed).withColumn("island", F.sum("_c").over(w.rowsBetween(W.unboundedPreceding, W.currentRow))).drop("_c")


def section_extent(blocks: DataFrame) -> DataFrame:
    """(document_id, block_id, level, pos, end_pos): a heading's section ends before the next heading of its level or above."""
    b = positioned(blocks).withColumn("level", F.when(F.col("block_type") == "title", heading_level(F.col("heading_level"), F.col("block_type"))))
    after = W.partitionBy("document_id").orderBy("pos").rowsBetween(1, W.unboundedFollowing)
    for n in LEVELS:
        b = b.withColumn(f"_n{n}", F.min(F.when(F.col("level") <= n, F.col("pos"))).over(after))
    last = F.max("pos").over(W.partitionBy("document_id"))
    end = F.coalesce(*[F.when(F.col("level") == n, F.col(f"_n{n}") - 1) for n in LEVELS], last)
    return b.withColumn("end_pos", end).where("level is not null").select("document_id", "block_id", "level", "pos", "end_pos")


def inferred_title(blocks: DataFrame, pages: int = 12) -> DataFrame:
    """Per document the earliest page's longest title of 4 to 120 characters that isn't generic."""
    t = F.trim("content")
    good = blocks.where((F.col("block_type") == "title") & (F.col("page_idx") < pages) & F.char_length(t).between(4, 120) & ~F.lower(t).isin(*GENERIC))
    best = W.partitionBy("document_id").orderBy("page_idx", F.desc("n"), "title", "block_id")
    return good.select("document_id", "page_idx", "block_id", t.alias("title"), F.char_length(t).alias("n")).withColumn("k", F.row_number().over(best)).where("k = 1").select("document_id", "title", "page_idx")


def page_roles(blocks: DataFrame) -> DataFrame:
    """(document_id, page_idx, role): one decision over each page's aggregates."""
    chars = F.char_length(F.trim(F.coalesce("content", F.lit(""))))
    numbered = F.col("content").rlike(r"[.·…]{3,}\s*[0-9]+\s*$|^(目录|[Cc]ontents)\s*$")
    p = blocks.where("page_idx is not null").groupBy("document_id", "page_idx").agg(
        F.sum(chars).alias("chars"), F.count("*").alias("blocks"), F.count_if(F.col("block_type") == "title").alias("titles"),
        F.count_if(F.col("block_type") == "image").alias("images"), F.count_if(numbered).alias("toc_lines"),
        F.count_if(F.col("block_type").isin("text", "list", "table", "code", "equation") & (chars > 0)).alias("bodies"),
    )
    role = F.when(F.col("toc_lines") >= 3, "toc").when(F.col("chars") == 0, F.when(F.col("images") > 0, "image").otherwise("blank")).when((F.col("page_idx") == 0) & (F.col("bodies") == 0), "cover").when((F.col("titles") > 0) & (F.col("bodies") == 0), "section_divider").otherwise("content")
    return p.withColumn("role", role)


def container_headings(blocks: DataFrame) -> DataFrame:
    """Headings followed by a deeper heading with less than 200 characters of body between."""
    e = section_extent(blocks)
    b = positioned(blocks).select("document_id", "pos", "block_type", F.char_length(F.trim(F.coalesce("content", F.lit("")))).alias("n"))
    own = W.partitionBy("document_id").orderBy("pos")
    nxt = e.withColumn("next_pos", F.lead("pos").over(own)).withColumn("next_level", F.lead("level").over(own)).where("next_level > level")
    body = b.where("block_type <> 'title'").select("document_id", F.sum("n").over(own.rowsBetween(W.unboundedPreceding, W.currentRow)).alias("upto"), "pos")
    # running sums at both ends instead of a range join
    at = nxt.select("document_id", "block_id", "level", F.explode(F.array("pos", "next_pos")).alias("pos"), F.lit(True).alias("mark"))
    marked = at.unionByName(body, allowMissingColumns=True)
    upto = F.max("upto").over(W.partitionBy("document_id").orderBy("pos").rangeBetween(W.unboundedPreceding, W.currentRow))
    run = marked.withColumn("sum", F.coalesce(upto, F.lit(0))).where("mark")
    return run.groupBy("document_id", "block_id", "level").agg((F.max("sum") - F.min("sum")).alias("body_chars")).where("body_chars < 200")
