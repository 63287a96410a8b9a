"""Evidence atoms and retrieval units: fixed chunks, parent-child chunks, concepts, context packing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkwell.functions.text import atom_id
from inkwell.operators.structure import islands, positioned

SEPARATOR = 2  # characters of the blank line between joined texts


def atoms(blocks: DataFrame) -> DataFrame:
    """Eligible blocks with a text, in document order, with canonical ids."""
    text = F.regexp_replace("content", r"^[ \t\n\r\f]+|[ \t\n\r\f]+$", "")
    b = positioned(blocks).withColumn("text", text).where("evidence_eligible and text <> '' and page_idx >= 0")
    page = F.col("page_idx") + 1
    return b.select(atom_id(F.col("document_id"), page, F.col("block_id")).alias("atom_id"), F.col("document_id").alias("article_id"), "source_file", page.alias("page"), "block_id", "block_type", "heading_path", "text", "pos", F.char_length("text").alias("n"))


def greedy_groups(sizes: Column, limit: Column) -> Column:
    """Group numbers from 0 for an ordered array of sizes: a new group begins where the next item and its separator no longer
    fit; an item over the limit is a group of its own. The fold's state is two numbers and the result."""
    start = F.struct(F.lit(0).alias("chars"), F.lit(0).alias("group"), F.expr("cast(array() as array<int>)").alias("out"))

    def step(s: Column, n: Column) -> Column:
        over = (s["chars"] > 0) & (s["chars"] + n + SEPARATOR > limit)
        group = F.when(over, s["group"] + 1).otherwise(s["group"])
        chars = F.when(over | (s["chars"] == 0), n).otherwise(s["chars"] + n + SEPARATOR)
        return F.struct(chars.alias("chars"), group.alias("group"), F.concat(s["out"], F.array(group)).alias("out"))

    return F.aggregate(sizes, start, step, lambda s: s["out"])


def pack(rows: DataFrame, part: list[str], order: str, size: str, limit: Column, group: str) -> DataFrame:
    """Adds ``group`` to rows packed greedily within their part. Only sizes and positions are gathered, never texts; a part is
    one document's or section's rows."""
    gathered = rows.groupBy(*part).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(size).alias("n")))).alias("rows"), F.max(limit).alias("_limit"))
    numbered = gathered.select(*part, F.explode(F.arrays_zip(F.transform("rows", lambda r: r["o"]).alias("o"), greedy_groups(F.transform("rows", lambda r: r["n"]), F.col("_limit")).alias("g"))).alias("z"))
    return rows.join(numbered.select(*part, F.col("z.o").alias(order), F.col("z.g").alias(group)), [*part, order])


def _joined(text: str, order: str) -> Column:
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda s: s[text]), "\n\n")


def fixed_chunks(atoms: DataFrame, max_chars: int = 1200) -> DataFrame:
    """Arm T0: whole atoms packed to at most ``max_chars``; an atom over it stays whole and the unit is marked oversized."""
    packed = pack(atoms, ["article_id"], "pos", "n", F.lit(max_chars), "g")
    u = packed.groupBy("article_id", "g").agg(
        F.array_sort(F.collect_list(F.struct("pos", "atom_id"))).alias("a"), _joined("text", "pos").alias("text"), F.min("page").alias("page_start"), F.max("page").alias("page_end")
    )
    name = F.concat(F.lit("t0-"), "article_id", F.lit("-"), F.lpad((F.col("g") + 1).cast("string"), 5, "0"))
    return u.select(name.alias("unit_id"), F.lit("T0").alias("arm"), "article_id", F.col("text").alias("retrieval_text"), F.transform("a", lambda x: x["atom_id"]).alias("retrieval_atoms"), F.col("text").alias("context_text"), F.transform("a", lambda x: x["atom_id"]).alias("context_atoms"), name.alias("context_id"), "page_start", "page_end", (F.char_length("text") > max_chars).alias("oversized"))


def parent_child(atoms: DataFrame, parent_chars: int = 4800, child_chars: int = 600) -> DataFrame:
    """Arm T1: runs of one heading path become parents, parents become children; the heading's prefix is charged to both
    budgets. Children are searched, parents are given as context."""
    prefix = F.array_join(F.coalesce("heading_path", F.expr("cast(array() as array<string>)")), " > ")
    a = islands(atoms.withColumn("prefix", prefix), F.col("prefix"), ["article_id"], ["pos"])
    charged = F.when(F.col("prefix") != "", F.char_length("prefix") + 2).otherwise(0)
    room = lambda n: F.greatest(F.lit(n) - charged, F.lit(1))
    a = pack(a, ["article_id", "island"], "pos", "n", room(parent_chars), "p")
    a = pack(a, ["article_id", "island", "p"], "pos", "n", room(child_chars), "c")
    head = F.when(F.col("prefix") != "", F.concat("prefix", F.lit("\n\n"))).otherwise("")
    listed = F.array_sort(F.collect_list(F.struct("pos", "atom_id")))
    parents = a.groupBy("article_id", "island", "p").agg(F.concat(F.first(head), _joined("text", "pos")).alias("context_text"), F.transform(listed, lambda x: x["atom_id"]).alias("context_atoms"))
    children = a.groupBy("article_id", "island", "p", "c").agg(F.concat(F.first(head), _joined("text", "pos")).alias("retrieval_text"), F.transform(listed, lambda x: x["atom_id"]).alias("retrieval_atoms"), F.min("page").alias("page_start"), F.max("page").alias("page_end"))
    number = lambda c: F.lpad(c.cast("string"), 4, "0")
    parent_id = F.concat(F.lit("t1p-"), "article_id", F.lit("-"), number(F.col("island")), F.lit("-"), number(F.col("p") + 1))
    unit_id = F.concat(F.lit("t1-"), "article_id", F.lit("-"), number(F.col("island")), F.lit("-"), number(F.col("p") + 1), F.lit("-"), number(F.col("c") + 1))
    out = children.join(parents, ["article_id", "island", "p"])
    return out.select(unit_id.alias("unit_id"), F.lit("T1").alias("arm"), "article_id", "retrieval_text", "retrieval_atoms", "context_text", "context_atoms", parent_id.alias("context_id"), "page_start", "page_end", (F.char_length("retrieval_text") > child_chars).alias("oversized"))


def concept_units(concepts: DataFrame, atoms: DataFrame) -> DataFrame:
    """Arm C1: a concept's title and body, with the atoms of its source blocks."""
    refs = concepts.select("filename", "title", "body", F.explode_outer(F.array_distinct("source_blocks")).alias("block_id"))
    a = refs.join(atoms.select("block_id", "atom_id", "article_id"), "block_id", "left")
    u = a.groupBy("filename").agg(F.first("title").alias("title"), F.first("body").alias("body"), F.array_sort(F.collect_set("atom_id")).alias("atoms"), F.min("article_id").alias("article_id"))
    text = F.concat_ws("\n\n", "title", "body")
    unit = F.concat(F.lit("c1-"), "filename")
    return u.select(unit.alias("unit_id"), F.lit("C1").alias("arm"), "article_id", text.alias("retrieval_text"), F.col("atoms").alias("retrieval_atoms"), text.alias("context_text"), F.col("atoms").alias("context_atoms"), unit.alias("context_id"))


def pack_context(ranked: DataFrame, budget: int, question: str = "question_id") -> DataFrame:
    """Per question: ranked contexts while they fit, skipping and going on. A context seen before is passed over, also if it
    was skipped. The count is that of the joined text: code points with the separators.

    ``ranked`` has question, rank, unit_id, context_id, n (size of the context's text)."""
    once = ranked.withColumn("_k", F.row_number().over(W.partitionBy(question, "context_id").orderBy("rank"))).where("_k = 1")
    g = once.groupBy(question).agg(F.array_sort(F.collect_list(F.struct("rank", "unit_id", "n"))).alias("rows"))
    none = F.expr("cast(array() as array<string>)")
    start = F.struct(F.lit(0).alias("used"), none.alias("taken"), none.alias("skipped"))

    def step(s: Column, r: Column) -> Column:
        total = F.when(F.size(s["taken"]) == 0, r["n"]).otherwise(s["used"] + r["n"] + SEPARATOR)
        fits = total <= budget
        return F.struct(F.when(fits, total).otherwise(s["used"]).alias("used"), F.when(fits, F.array_append(s["taken"], r["unit_id"])).otherwise(s["taken"]).alias("taken"), F.when(fits, s["skipped"]).otherwise(F.array_append(s["skipped"], r["unit_id"])).alias("skipped"))

    return g.select(question, F.aggregate("rows", start, step).alias("s")).select(question, F.col("s.taken").alias("unit_ids"), F.col("s.used").alias("token_count"), F.col("s.skipped").alias("skipped"))
