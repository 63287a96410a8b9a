"""Mixing sources to target shares of all tokens.

Each source's documents get hash-random keys. A source's budget is whole epochs of all its documents and a rest; the rest is cut
from the order of keys by prefix sums. The sums are two-level: a source's keys are split into ranges by their leading bits, the
ranges are summed in parallel, a window over the ranges (a bounded number a source) gives each range's start, and a window
within the range the rest. So a source with a third of all rows is spread over thousands of tasks' groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

RANGE_BITS = 12  # 4096 ranges a source


def source_key(column: str = "source"):
    """Sources are the same if they agree after trimming (any white space) and lower-casing."""
    return F.lower(F.regexp_replace(column, r"^\s+|\s+$", ""))


def budgets(sized: DataFrame, targets: DataFrame, total: int | None = None) -> DataFrame:
    """One row a target source: what it has, its budget in tokens, full epochs and the rest.

    Without ``total`` the mix is as large as it can be: all sources with tokens reach their shares and none exceeds its repeats.
    With ``total``, a source whose documents times max_repeats fall short gives all it may, and its actual share shows it.
    """
    have = sized.groupBy("source").agg(F.count("*").alias("available_docs"), F.sum("n_tokens").alias("available_tokens"))
    t = targets.select(source_key().alias("source"), F.col("target_share").cast("double"), F.col("max_repeats").cast("int")).where("source is not null")
    t = t.groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    b = F.broadcast(t).join(have, "source", "left").fillna(0, ["available_docs", "available_tokens", "max_repeats", "target_share"])  # the targets are a short fixed table
    most = F.col("available_tokens") * F.greatest("max_repeats", F.lit(0))
    if total is None:
        size = F.min(F.when((most > 0) & (F.col("target_share") > 0), most / F.col("target_share"))).over(W.partitionBy(F.lit(0)))
    else:
        size = F.lit(float(total))
    b = b.withColumn("budget", F.least(F.floor(F.col("target_share") * size + 0.5), most).cast("long")).fillna(0, ["budget"])
    epochs = F.when(F.col("available_tokens") > 0, F.expr("budget div available_tokens")).otherwise(F.lit(0)).cast("int")
    return b.withColumn("epochs", epochs).withColumn("rest", F.col("budget") - F.col("epochs") * F.col("available_tokens"))


def mix(sized: DataFrame, targets: DataFrame, total: int | None = None, seed: int = 42) -> DataFrame:
    """(doc_id, source, n_tokens, repeats) of the chosen documents.

    ``sized`` has doc_id, source, n_tokens, one row a document. A document belongs to the rest if the middle of its stretch of
    tokens lies before the cut, so a source misses its budget by half a document at most. Documents without tokens, without a
    source, or of sources not listed are not chosen; ties of keys are settled by doc_id; an empty table gives no rows.
    """
    s = sized.select("doc_id", source_key().alias("source"), F.coalesce("n_tokens", F.lit(0)).cast("long").alias("n_tokens")).where("n_tokens > 0 and source is not null")
    b = budgets(s, targets, total)
    keyed = s.join(F.broadcast(b.where("budget > 0").select("source", "epochs", "rest", "max_repeats")), "source").withColumn("key", F.xxhash64(F.lit(seed), "doc_id"))
    keyed = keyed.withColumn("range", F.shiftright("key", 64 - RANGE_BITS))
    ranges = keyed.groupBy("source", "range").agg(F.sum("n_tokens").alias("in_range"))
    ranges = ranges.withColumn("before", F.coalesce(F.sum("in_range").over(W.partitionBy("source").orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    inside = W.partitionBy("source", "range").orderBy("key", "doc_id").rowsBetween(W.unboundedPreceding, W.currentRow)
    # at most 4096 ranges for each of the few listed sources
    placed = keyed.join(ranges.select("source", "range", "before"), ["source", "range"]).withColumn("upto", F.col("before") + F.sum("n_tokens").over(inside))
    more = ((F.col("upto") - F.col("n_tokens") / 2) <= F.col("rest")) & (F.col("rest") > 0) & (F.col("epochs") < F.col("max_repeats"))
    out = placed.withColumn("repeats", F.col("epochs") + more.cast("int"))
    return out.where("repeats > 0").select("doc_id", "source", "n_tokens", "repeats")


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """Actual shares: one row a target source, also for sources that gave nothing (actual_share 0)."""
    got = mixed.groupBy("source").agg(F.count("*").alias("docs"), F.sum("repeats").alias("uses"), F.max("repeats").alias("most_repeats"), F.sum(F.col("n_tokens") * F.col("repeats")).alias("tokens"))
    t = targets.select(source_key().alias("source"), "target_share", "max_repeats").where("source is not null")
    t = t.groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    out = F.broadcast(t).join(got, "source", "left").fillna(0, ["docs", "uses", "most_repeats", "tokens"])
    whole = F.sum("tokens").over(W.partitionBy(F.lit(0)))
    return out.withColumn("actual_share", F.when(whole > 0, F.col("tokens") / whole).otherwise(F.lit(0.0)))
