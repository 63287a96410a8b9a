"""Answers and claims against gold facts; segments, catalogs, overlays and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def answer_scores(required: DataFrame, forbidden: DataFrame, claimed: DataFrame, questions: DataFrame) -> DataFrame:
    """Per question: weighted fact recall and precision, whether all critical facts are matched, contradictions, correctness.

    required: question_id, fact_id, weight, critical; forbidden and claimed: question_id, fact_id; questions: question_id,
    answerable, predicted_answerable. A claimed fact that is neither counts with weight 1 against precision; without required facts
    recall and precision are null."""
    c = claimed.select("question_id", "fact_id").distinct().withColumn("claimed", F.lit(True))
    r = required.join(c, ["question_id", "fact_id"], "left").groupBy("question_id").agg(
        F.sum("weight").alias("total"), F.sum(F.when(F.col("claimed"), F.col("weight")).otherwise(0.0)).alias("matched"), F.bool_and(~F.col("critical") | F.coalesce("claimed", F.lit(False))).alias("critical_ok")
    )
    known = required.select("question_id", "fact_id", F.lit("r").alias("side")).unionByName(forbidden.select("question_id", "fact_id", F.lit("f").alias("side")))
    other = c.join(known, ["question_id", "fact_id"], "left").groupBy("question_id").agg(F.count_if(F.col("side").isNull()).alias("unknown"), F.count_if(F.col("side") == "f").alias("contradicted"), F.count("*").alias("n_claimed"))
    j = questions.join(r, "question_id", "left").join(other, "question_id", "left").fillna(0, ["unknown", "contradicted", "n_claimed"])
    contradiction = F.col("contradicted") > 0
    recall = F.col("matched") / F.col("total")
    precision = F.when(F.col("total").isNotNull(), F.when(F.col("matched") + F.col("unknown") > 0, F.col("matched") / (F.col("matched") + F.col("unknown"))).otherwise(0.0))
    right = F.when(F.col("answerable"), F.col("predicted_answerable") & F.coalesce("critical_ok", F.lit(True)) & ~contradiction & (F.col("unknown") == 0)).otherwise(~F.col("predicted_answerable") & (F.col("n_claimed") == 0))
    return j.select("question_id", recall.alias("fact_recall"), precision.alias("fact_precision"), F.coalesce("critical_ok", F.lit(True)).alias("critical_ok"), contradiction.alias("contradiction"), right.alias("correct"))


def citation_scores(citations: DataFrame, gold: DataFrame, universe: DataFrame, questions: DataFrame) -> DataFrame:
    """Per question: validity (cited atoms that exist, repeats counted), precision and whether a whole gold set is cited."""
    u = universe.select("atom_id").distinct().withColumn("exists", F.lit(True))
    v = citations.join(u, "atom_id", "left").groupBy("question_id").agg((F.count("exists") / F.count("*")).alias("validity"))
    c = citations.select("question_id", "atom_id").distinct().withColumn("cited", F.lit(True))
    g = gold.select("question_id", "atom_id").distinct().withColumn("is_gold", F.lit(True))
    p = c.join(g, ["question_id", "atom_id"], "left").groupBy("question_id").agg((F.count("is_gold") / F.count("*")).alias("precision"))
    whole = gold.select("question_id", "set_id", "atom_id").distinct().join(c, ["question_id", "atom_id"], "left").groupBy("question_id", "set_id").agg(F.bool_and(F.coalesce("cited", F.lit(False))).alias("all")).groupBy("question_id").agg(F.bool_or("all").alias("complete"))
    j = questions.join(v, "question_id", "left").join(p, "question_id", "left").join(whole, "question_id", "left")
    return j.select("question_id", F.coalesce("validity", F.when(F.col("answerable"), 0.0).otherwise(1.0)).alias("validity"), F.when(F.col("answerable"), F.coalesce("precision", F.lit(0.0))).alias("precision"), F.when(F.col("answerable"), F.coalesce("complete", F.lit(False))).alias("complete"))


def joint_success(answers: DataFrame, retrieval: DataFrame, citations: DataFrame) -> DataFrame:
    """Correct, everything retrieved, everything cited and all citations valid; null where correctness is."""
    j = answers.select("question_id", "correct").join(retrieval.select("question_id", F.col("complete").alias("retrieved")), "question_id", "left").join(citations.select("question_id", "validity", F.col("complete").alias("cited")), "question_id", "left")
    ok = (F.coalesce(F.col("retrieved") == 1, F.lit(False))) & F.coalesce("cited", F.lit(False)) & (F.coalesce("validity", F.lit(0.0)) == 1.0)
    return j.select("question_id", F.when(F.col("correct").isNotNull(), F.col("correct") & ok).alias("success"))


def segments(rows: DataFrame, part: str, order: str, size: str, heading: Column, target: int, hard: int) -> DataFrame:
    """``segment`` from 0: a new one begins at a heading, once the target is reached, or where the hard limit would be passed."""
    g = rows.withColumn("_h", heading).groupBy(part).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(size).alias("n"), F.col("_h").alias("h")))).alias("rows"))
    start = F.struct(F.lit(-1).alias("chars"), F.lit(0).alias("s"), F.expr("cast(array() as array<int>)").alias("out"))

    def step(a: Column, r: Column) -> Column:
        new = (a["chars"] >= 0) & (r["h"] | (a["chars"] >= target) | (a["chars"] + r["n"] + 2 > hard))
        s = F.when(new, a["s"] + 1).otherwise(a["s"])
        chars = F.when(new | (a["chars"] < 0), r["n"]).otherwise(a["chars"] + r["n"] + 2)
        return F.struct(chars.alias("chars"), s.alias("s"), F.concat(a["out"], F.array(s)).alias("out"))

    n = g.select(part, F.explode(F.arrays_zip(F.transform("rows", lambda r: r["o"]).alias("o"), F.aggregate("rows", start, step, lambda a: a["out"]).alias("s"))).alias("z"))
    return rows.join(n.select(part, F.col("z.o").alias(order), F.col("z.s").alias("segment")), [part, order])


def overlay(rows: DataFrame, keys: list[str], better: list[Column]) -> DataFrame:
    """One row a key: the recovered one if there is a better, by the order given."""
    return rows.withColumn("_k", F.row_number().over(W.partitionBy(*keys).orderBy(*better))).where("_k = 1").drop("_k")


def quota_sample(rows: DataFrame, part: list[str], stratum: str, quotas: dict[str, int], key: str) -> DataFrame:
    """At most a stratum's quota of rows a part, by hash order, so the choice doesn't depend on delivery."""
    quota = F.create_map(*[F.lit(x) for kv in quotas.items() for x in kv])[F.col(stratum)]
    k = F.row_number().over(W.partitionBy(*part, stratum).orderBy(F.sha2(key, 256), key))
    return rows.withColumn("slot", k).where(F.col("slot") <= F.coalesce(quota, F.lit(0)))


def toc_line(c: Column) -> tuple[Column, Column]:
    """(title, page) of a line of contents: leaders or blanks and a page number behind, or a number before; nulls otherwise."""
    behind = r"^(.*?\S)(?:[ .·…　]{2,}|\s+)([0-9]{1,4})\s*$"
    before = r"^([0-9]{1,4})\s{2,}(\S.*)$"
    title = F.when(c.rlike(behind), F.regexp_extract(c, behind, 1)).when(c.rlike(before), F.regexp_extract(c, before, 2))
    page = F.when(c.rlike(behind), F.regexp_extract(c, behind, 2)).when(c.rlike(before), F.regexp_extract(c, before, 1)).cast("int")
    return title, page


def blank_image(ink: Column, entropy: Column) -> Column:
    return (ink <= 0.003) & (entropy <= 1.2)


def pixel_box(box: Column, width: Column, height: Column) -> Column:
    """A box in shares of the page as a pixel box of at least one pixel within it; null unless it is four shares of 0 to 1."""
    at = lambda i, n: F.rint(box[i] * n).cast("int")
    left, top = (F.greatest(F.lit(0), F.least(n - 1, at(i, n))) for i, n in ((0, width), (1, height)))
    right, bottom = (F.greatest(lo + 1, F.least(n, at(i, n))) for lo, i, n in ((left, 2, width), (top, 3, height)))
    valid = (F.size(box) == 4) & F.forall(box, lambda x: x.isNotNull() & (x >= 0) & (x <= 1))
    return F.when(valid, F.array(left, top, right, bottom))


def render(template: str, values: dict[str, Column]) -> Column:
    """``{name}`` placeholders filled with columns; an unknown name is an error."""
    import re

    parts, done = [], 0
    for m in re.finditer(r"\{(\w+)\}", template):
        if m[1] not in values:
            raise KeyError(m[1])
        parts += [F.lit(template[done : m.start()]), F.coalesce(values[m[1]].cast("string"), F.lit(""))]
        done = m.end()
    return F.concat(*parts, F.lit(template[done:]))
