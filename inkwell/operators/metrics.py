"""Retrieval and answer metrics. Null means undefined and is skipped by means."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def atom_metrics(ranked: DataFrame, gold: DataFrame, k: int) -> DataFrame:
    """Per question over its first k units, expanded to atoms in rank order (first occurrence counts): recall of the best
    alternative set, completeness, MRR on the atom's position, graded nDCG with the ideal cut to the atoms returned, precision.

    ranked: question_id, rank, atoms array; gold: question_id, set_id, atom_id. Questions without gold have no row."""
    a = ranked.where(F.col("rank") <= k).select("question_id", "rank", F.posexplode("atoms").alias("i", "atom_id"))
    first = a.groupBy("question_id", "atom_id").agg(F.min(F.struct("rank", "i")).alias("at"))
    placed = first.withColumn("position", F.row_number().over(W.partitionBy("question_id").orderBy("at", "atom_id")))
    returned = placed.groupBy("question_id").agg(F.count("*").alias("returned"))
    g = gold.select("question_id", "set_id", "atom_id").distinct()
    sets = g.join(placed.select("question_id", "atom_id", "position"), ["question_id", "atom_id"], "left").groupBy("question_id", "set_id").agg((F.count("position") / F.count("*")).alias("recall"))
    best = sets.groupBy("question_id").agg(F.max("recall").alias("recall"), F.max((F.col("recall") == 1).cast("int")).alias("complete"))
    relevant = g.select("question_id", "atom_id").distinct()
    gain = relevant.join(placed, ["question_id", "atom_id"], "left").groupBy("question_id").agg(
        F.count("*").alias("n_gold"), F.min("position").alias("first"), F.count("position").alias("found"), F.sum(3.0 / F.log2(F.col("position") + 1.0)).alias("dcg")
    )
    out = best.join(gain, "question_id").join(returned, "question_id", "left").fillna(0, ["returned"])
    ideal = F.aggregate(F.transform(F.sequence(F.lit(1), F.greatest(F.least("n_gold", "returned"), F.lit(1)).cast("int")), lambda i: 3.0 / F.log2(i + 1.0)), F.lit(0.0), lambda s, x: s + x)
    ndcg = F.when((F.col("returned") > 0), F.coalesce(F.col("dcg"), F.lit(0.0)) / ideal).otherwise(0.0)
    return out.select("question_id", "recall", "complete", F.when(F.col("first").isNotNull(), 1.0 / F.col("first")).otherwise(0.0).alias("mrr"), ndcg.alias("ndcg"), F.when(F.col("returned") > 0, F.col("found") / F.col("returned")).otherwise(0.0).alias("precision"))


def unit_metrics(ranked: DataFrame, gold: DataFrame, cuts: tuple[int, ...] = (5, 10, 20, 50)) -> DataFrame:
    """Per question: recall of gold blocks at each cut, MRR on the unit's rank, binary nDCG at the last cut."""
    g = gold.select("question_id", F.col("atom_id").alias("atom")).distinct()
    n = g.groupBy("question_id").agg(F.count("*").alias("n_gold"))
    hit = ranked.select("question_id", "rank", F.explode("atoms").alias("atom")).join(g, ["question_id", "atom"])
    by_atom = hit.groupBy("question_id", "atom").agg(F.min("rank").alias("rank"))
    recalls = by_atom.groupBy("question_id").agg(*[F.count_if(F.col("rank") <= c).alias(f"found_{c}") for c in cuts], F.min("rank").alias("first"))
    units = hit.select("question_id", "rank").distinct().where(F.col("rank") <= cuts[-1])
    dcg = units.groupBy("question_id").agg(F.sum(1.0 / F.log2(F.col("rank") + 1.0)).alias("dcg"), F.count("*").alias("relevant"))
    out = n.join(recalls, "question_id", "left").join(dcg, "question_id", "left")
    ideal = F.aggregate(F.transform(F.sequence(F.lit(1), F.greatest(F.coalesce("relevant", F.lit(1)), F.lit(1)).cast("int")), lambda i: 1.0 / F.log2(i + 1.0)), F.lit(0.0), lambda s, x: s + x)
    return out.select("question_id", *[(F.coalesce(F.col(f"found_{c}"), F.lit(0)) / F.col("n_gold")).alias(f"recall_{c}") for c in cuts], F.when(F.col("first").isNotNull(), 1.0 / F.col("first")).otherwise(0.0).alias("mrr"), F.coalesce(F.col("dcg") / ideal, F.lit(0.0)).alias("ndcg"))


def win_tie_loss(left: DataFrame, right: DataFrame, metric: str, eps: float = 1e-9) -> DataFrame:
    d = left.select("question_id", F.col(metric).alias("l")).join(right.select("question_id", F.col(metric).alias("r")), "question_id").withColumn("d", F.col("l") - F.col("r"))
    return d.agg(F.count("*").alias("n"), F.count_if(F.col("d") > eps).alias("wins"), F.count_if(F.abs("d") <= eps).alias("ties"), F.count_if(F.col("d") < -eps).alias("losses"), F.avg("d").alias("mean_delta"))


def confusion(df: DataFrame, gold: str, predicted: str, keys: list[str]) -> DataFrame:
    """TP, FP, FN, TN, precision, recall and F1 of a boolean; 0 where a denominator is 0."""
    g, p = F.col(gold), F.col(predicted)
    c = df.groupBy(*keys).agg(F.count_if(g & p).alias("tp"), F.count_if(~g & p).alias("fp"), F.count_if(g & ~p).alias("fn"), F.count_if(~g & ~p).alias("tn"))
    safe = lambda n, d: F.when(d == 0, 0.0).otherwise(n / d)
    c = c.withColumn("precision", safe(F.col("tp"), F.col("tp") + F.col("fp"))).withColumn("recall", safe(F.col("tp"), F.col("tp") + F.col("fn")))
    return c.withColumn("f1", safe(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


#: Up to so many numbered pairs go to every task of ``bootstrap``; more are joined to the draws by shuffles, with the same result.
REPLICATED = 200_000


def paired_differences(baseline: DataFrame, candidate: DataFrame, metric: str) -> DataFrame:
    """(id, d) of each question that both arms have: candidate - baseline."""
    both = baseline.select("question_id", F.col(metric).alias("b")).join(candidate.select("question_id", F.col(metric).alias("c")), "question_id")
    return both.select(F.col("question_id").alias("id"), (F.col("c") - F.col("b")).alias("d"))


def bootstrap(pairs: DataFrame, samples: int = 10_000, seed: int = 42) -> DataFrame:
    """Paired bootstrap of the mean of ``d``: each resample draws as many pairs as there are, by hash of (seed, sample, draw);
    the pairs are numbered in order of id. One row: mean, and the 2.5 and 97.5 percentiles of the resampled means.

    The draws are rows of their own joined to the numbered pairs, so nothing is gathered in one task."""
    n = pairs.count()
    if n == 0:
        return pairs.sparkSession.createDataFrame([], "n long, mean double, low double, high double")
    bands = max(1, n // 50_000)
    numbered = number_rows(pairs.select("id", "d"), "id", bands)
    spark = pairs.sparkSession
    draws = spark.range(samples * n).select((F.col("id") % samples).alias("sample"), (F.col("id") / samples).cast("long").alias("draw"))
    text = F.concat_ws(":", F.lit(str(seed)), "sample", "draw")
    draws = draws.select("sample", F.pmod(F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long"), F.lit(n)).alias("i"))
    if n <= REPLICATED:
        drawn = draws.join(F.broadcast(numbered), "i").withColumn("k", F.lit(1))  # no draw is shuffled, only sums of samples
    else:
        drawn = draws.groupBy("sample", "i").agg(F.count("*").alias("k")).join(numbered, "i")
    means = drawn.groupBy("sample").agg((F.sum(F.col("d") * F.col("k")) / n).alias("m"))
    ci = means.agg(F.percentile("m", 0.025).alias("low"), F.percentile("m", 0.975).alias("high"))
    return pairs.agg(F.count("*").alias("n"), F.avg("d").alias("mean")).join(F.broadcast(ci))


def number_rows(df: DataFrame, key: str, bands: int) -> DataFrame:
    """``i``: rows numbered from 0 in order of key, by range partitions, their sizes' prefix sums and a window in each."""
    parts = df.repartitionByRange(bands, key).withColumn("_p", F.spark_partition_id()) if bands > 1 else df.withColumn("_p", F.lit(0))
    sizes = parts.groupBy("_p").agg(F.count("*").alias("_s"))
    offsets = sizes.withColumn("_o", F.coalesce(F.sum("_s").over(W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).select("_p", "_o")
    inside = parts.withColumn("_r", F.row_number().over(W.partitionBy("_p").orderBy(key)))
    return inside.join(F.broadcast(offsets), "_p").select(*df.columns, (F.col("_o") + F.col("_r") - 1).alias("i"))
