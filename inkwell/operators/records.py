"""Deliveries, keys, hashes and audits over plain tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest(df: DataFrame, key: str | list[str], by: str) -> DataFrame:
    """One row a key, the one delivered last; the window is cut to its first row before the shuffle's sort is read on."""
    keys = [key] if isinstance(key, str) else key
    order = W.partitionBy(*keys).orderBy(F.desc_nulls_last(by))
    return df.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def hash_status(df: DataFrame, content: str, asset: str, given: str) -> DataFrame:
    """Compares a recorded content hash with the content: ok, spelling (right but for case, blanks or a prefix), stale, missing."""
    real = F.sha2(F.concat(F.coalesce(content, F.lit("")), F.lit("\0"), F.coalesce(asset, F.lit(""))), 256)
    bare = F.regexp_replace(F.lower(F.trim(given)), r"^sha-?256:", "")
    status = F.when(F.col(given).isNull() | (F.trim(given) == ""), "missing").when(F.col(given) == real, "ok").when(bare == real, "spelling").otherwise("stale")
    return df.withColumn("real_hash", real).withColumn("hash_status", status)


def distribution(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """count, sum, mean, p50, p95, min and max of a measure; exact percentiles, nulls skipped."""
    v = F.col(value).cast("double")
    return df.groupBy(*keys).agg(
        F.count(v).alias("n"), F.sum(v).alias("total"), F.avg(v).alias("mean"), F.percentile(v, 0.5).alias("p50"), F.percentile(v, 0.95).alias("p95"), F.min(v).alias("least"), F.max(v).alias("most")
    )


def anti(left: DataFrame, right: DataFrame, on: str | list[str]) -> DataFrame:
    return left.join(right, on, "left_anti")


def two_way_audit(left: DataFrame, right: DataFrame, key: str, left_name: str, right_name: str) -> DataFrame:
    """Keys that only one side has, with the side they are missing from."""
    only = lambda a, b, name: anti(a.select(key).distinct(), b.select(key).distinct(), key).select(key, F.lit(name).alias("missing_in"))
    return only(left, right, right_name).unionByName(only(right, left, left_name))


def duplicate_groups(df: DataFrame, key: str, text: Column) -> DataFrame:
    """Groups of equal texts by hash: the first key and the size, for groups of two and more. Members aren't collected."""
    return df.groupBy(F.sha2(text, 256).alias("hash")).agg(F.min(key).alias("first_key"), F.count("*").alias("copies")).where("copies > 1")


def first_non_null(column: str, by: str) -> Column:
    """The first value that isn't null, in order of ``by``, as a mergeable aggregate."""
    return F.min_by(column, F.when(F.col(column).isNotNull(), F.col(by)))


def needs_compile(wanted: DataFrame, state: DataFrame, key: str) -> DataFrame:
    """Rows whose fingerprint differs from the recorded state, or that have none or an unfinished one."""
    s = state.select(key, F.col("fingerprint").alias("old_fingerprint"), F.col("complete"))
    joined = wanted.join(s, key, "left")
    reason = F.when(F.col("old_fingerprint").isNull(), "new").when(F.col("old_fingerprint") != F.col("fingerprint"), "changed").when(~F.col("complete"), "incomplete").otherwise("reuse")
    return joined.withColumn("action", reason)


def leak_scan(df: DataFrame, key: str, text: str, rules: dict[str, str]) -> DataFrame:
    """(key, rule, hits) of every rule that matches a text."""
    hits = F.array(*[F.struct(F.lit(name).alias("rule"), F.regexp_count(text, F.lit(rule)).alias("hits")) for name, rule in rules.items()])
    return df.select(key, F.explode(F.filter(hits, lambda h: h["hits"] > 0)).alias("h")).select(key, "h.rule", "h.hits")
