"""Snapshots against each other, scopes, and coverage decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def scope_relation(l_time: Column, r_time: Column, l_place: Column, r_place: Column) -> Column:
    """same, overlap, temporal_variant, scenario_variant or unknown. Times are (lo, hi) structs or null, places arrays.

    A side without any dimension is unknown; a dimension one side lacks says nothing; years that overlap count as same."""
    lt, rt, lp, rp = l_time.isNotNull(), r_time.isNotNull(), F.size(l_place) > 0, F.size(r_place) > 0
    time = F.when(lt & rt, F.when((l_time["lo"] <= r_time["hi"]) & (r_time["lo"] <= l_time["hi"]), "same").otherwise("disjoint"))
    place = F.when(lp & rp, F.when(F.arrays_overlap(l_place, r_place), "same").otherwise("disjoint"))
    known_l, known_r = lt | lp, rt | rp
    return F.when(~known_l | ~known_r, "unknown").when(time == "disjoint", "temporal_variant").when(place == "disjoint", "scenario_variant").when((time == "same") & (place == "same"), "same").otherwise("overlap")


def reconcile(old: DataFrame, new: DataFrame, key: str, content: str) -> DataFrame:
    """(key, n, status): one-to-one matches within a key, first the equal contents, then the rest in order of content;
    unchanged, revised, added or not_repeated. Old rows are kept as history, whatever their status.

    Equal contents are paired by their number within (key, content), the rest by their number within the key: two full outer
    joins instead of a greedy loop."""
    nth = lambda df, side: df.select(key, F.col(content).alias("c")).withColumn("n", F.row_number().over(W.partitionBy(key, "c").orderBy("c"))).withColumn(side, F.lit(True))
    o, n = nth(old, "o"), nth(new, "w")
    both = o.join(n, [key, "c", "n"], "full_outer")
    equal = both.where("o and w").select(key, F.lit("unchanged").alias("status"))
    rest = lambda cond, side: both.where(cond).select(key, "c").withColumn("k", F.row_number().over(W.partitionBy(key).orderBy("c"))).withColumn(side, F.lit(True)).drop("c")
    left = rest("o and w is null", "o2").join(rest("w and o is null", "w2"), [key, "k"], "full_outer")
    status = F.when(F.col("o2") & F.col("w2"), "revised").when(F.col("w2"), "added").otherwise("not_repeated")
    return equal.unionByName(left.select(key, status.alias("status")))


def group_changes(old: DataFrame, new: DataFrame, group: str, member: str) -> DataFrame:
    """(group, state): reused if its members are the same, else affected, or retired if the new run lacks it. Members are
    compared by their number and an order-free sum of hashes, not gathered."""
    mark = lambda df, x: df.select(group, member).distinct().groupBy(group).agg(F.count("*").alias("n" + x), F.sum(F.xxhash64(member).cast("decimal(38,0)")).alias("h" + x))
    j = mark(old, "o").join(mark(new, "w"), group, "full_outer")
    return j.select(group, F.when(F.col("nw").isNull(), "retired").when((F.col("no") == F.col("nw")) & (F.col("ho") == F.col("hw")), "reused").otherwise("affected").alias("state"))


SEVERITY = {"contradicted": 3, "uncertain": 2, "covered": 1}


def worst_status(claims: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Each claim's worst status, ties to the earliest batch; claims without a row are omitted. rows: keys, status, batch."""
    rank = F.create_map(*[F.lit(x) for kv in SEVERITY.items() for x in kv])[F.col("status")]
    worst = rows.groupBy(*keys).agg(F.min_by(F.struct("status", "batch"), F.struct(-rank, "batch")).alias("w"))
    return claims.select(*keys).distinct().join(worst, keys, "left").select(*keys, F.coalesce("w.status", F.lit("omitted")).alias("status"), F.col("w.batch").alias("batch"))


def review_decision(merged: DataFrame, group: str) -> DataFrame:
    """human_review if anything is uncertain, recompile if anything is contradicted or omitted, else pass."""
    has = lambda *s: F.bool_or(F.col("status").isin(*s))
    return merged.groupBy(group).agg(F.count("*").alias("claims"), F.when(has("uncertain"), "human_review").when(has("contradicted", "omitted"), "recompile").otherwise("pass").alias("decision"))
