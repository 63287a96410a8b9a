"""Entity resolution: blocking, candidate edges, components, constrained clusters, plans."""

from __future__ import annotations

from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkwell.functions.text import term_set
from inkwell.session import checkpoint


def candidate_edges(refs: DataFrame, top: int = 8, least: float = 0.06) -> DataFrame:
    """(left_ref, right_ref, score): refs of one type and different articles that share a term, scored by the Jaccard index of
    their term sets, the best ``top`` of each ref, each pair once with the smaller id left.

    refs: ref_id, kind, article_id, text. Shared terms are counted by a join on (kind, term) with partial sums before the
    shuffle; set sizes come along, so no set is joined to another."""
    t = refs.select("ref_id", "kind", "article_id", term_set(F.col("text")).alias("t"))
    rows = t.select("ref_id", "kind", "article_id", F.size("t").alias("n"), F.explode("t").alias("term"))
    a = rows.select("kind", "term", *[F.col(c).alias("l_" + c) for c in ("ref_id", "article_id", "n")])
    b = rows.select("kind", "term", *[F.col(c).alias("r_" + c) for c in ("ref_id", "article_id", "n")])
    pairs = a.join(b, ["kind", "term"]).where("l_ref_id < r_ref_id and l_article_id <> r_article_id")
    pairs = pairs.groupBy("l_ref_id", "r_ref_id").agg(F.count("*").alias("common"), F.first("l_n").alias("ln"), F.first("r_n").alias("rn"))
    scored = pairs.withColumn("score", F.col("common") / (F.col("ln") + F.col("rn") - F.col("common"))).where(F.col("score") >= least)
    both = scored.select(F.col("l_ref_id").alias("ref_id"), F.col("r_ref_id").alias("other"), "score").unionByName(scored.select(F.col("r_ref_id").alias("ref_id"), F.col("l_ref_id").alias("other"), "score"))
    kept = both.withColumn("k", F.row_number().over(W.partitionBy("ref_id").orderBy(F.desc(F.round("score", 9)), "other"))).where(F.col("k") <= top)
    return kept.groupBy(F.least("ref_id", "other").alias("left_ref"), F.greatest("ref_id", "other").alias("right_ref")).agg(F.max("score").alias("score"))


def components(edges: DataFrame, a: str = "left_ref", b: str = "right_ref", most_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node of each connected component, by smallest neighbour and pointer jumping; a round is a
    checkpoint in the shared folder, rounds grow with the logarithm of a component's diameter."""
    both = checkpoint(edges.select(F.col(a).alias("x"), F.col(b).alias("y")).unionByName(edges.select(F.col(b).alias("x"), F.col(a).alias("y"))).distinct())
    labels = both.select(F.col("x").alias("node"), F.col("x").alias("label")).distinct()
    for _ in range(most_rounds):
        near = both.join(labels, both.y == labels.node).groupBy("x").agg(F.min("label").alias("near"))
        step = labels.join(near, labels.node == near.x, "left").select("node", F.least("label", F.coalesce("near", "label")).alias("to"), F.col("label").alias("old"))
        jump = step.select(F.col("node").alias("to"), F.col("to").alias("far"))
        after = checkpoint(step.join(jump, "to", "left").select("node", F.least(F.col("to"), F.coalesce("far", F.col("to"))).alias("label"), "old"))
        labels = after.select("node", "label")
        if after.where("label < old").isEmpty():
            return labels.withColumnRenamed("label", "component")
    raise RuntimeError("components: not settled")


def constrained_clusters(judged: DataFrame) -> DataFrame:
    """(node, cluster): edges judged same, complementary, related or separate; mergeable ones are taken in order of edge id.

    Two clusters merge only if the smallest member of both was itself judged mergeable with the edge's own end on the other side,
    no separate pair would meet, and all kinds agree (left_kind and right_kind, where given). A cluster is named by its smallest
    member. The order matters, so it is a fold, run per component of the mergeable edges; components are what bounds a task's rows."""
    kinds = [F.col(c) if c in judged.columns else F.lit("").alias(c) for c in ("left_kind", "right_kind")]
    rows = judged.select("edge_id", "left_ref", "right_ref", "decision", *kinds)
    comp = components(rows.where(F.col("decision").isin("same", "complementary")), "left_ref", "right_ref")
    at = lambda c: comp.select(F.col("node").alias(c), F.col("component").alias("of_" + c))
    placed = rows.join(at("left_ref"), "left_ref", "left").join(at("right_ref"), "right_ref", "left")
    alone = placed.select(F.explode(F.array(F.struct(F.col("left_ref").alias("node"), F.col("of_left_ref").alias("c")), F.struct(F.col("right_ref").alias("node"), F.col("of_right_ref").alias("c")))).alias("x")).where("x.c is null")
    # other edges matter only where they hold two of one component apart
    inside = placed.where("of_left_ref = of_right_ref").withColumnRenamed("of_left_ref", "component").select("component", *rows.columns)

    def one(t: pa.Table) -> pa.Table:
        of = fold(list(zip(*(t.column(c).to_pylist() for c in ("edge_id", "left_ref", "right_ref", "decision", "left_kind", "right_kind")))))
        return pa.table({"node": sorted(of), "cluster": [of[n] for n in sorted(of)]})

    return inside.groupBy("component").applyInArrow(one, "node string, cluster string").unionByName(alone.select(F.col("x.node").alias("node"), F.col("x.node").alias("cluster")).distinct())


def fold(edges: list[tuple]) -> dict[str, str]:
    """The merges of ``constrained_clusters`` over (edge_id, left, right, decision, left_kind, right_kind)."""
    kind: dict[str, str] = {}
    merge, apart = set(), defaultdict(set)
    for _, a, b, decision, ka, kb in edges:
        kind.setdefault(a, ka)
        kind.setdefault(b, kb)
        if decision in ("same", "complementary"):
            merge.add(frozenset((a, b)))
        elif decision == "separate":
            apart[a].add(b)
            apart[b].add(a)
    members = {x: {x} for x in kind}  # by the cluster's smallest member; the smaller set is added to the larger
    of = {x: x for x in kind}
    shunned = {x: set(apart[x]) for x in kind}
    for _, a, b, decision, _, _ in sorted(edges):
        x, y = of[a], of[b]
        if decision not in ("same", "complementary") or x == y:
            continue
        low, high = min(x, y), max(x, y)
        incoming = b if low == x else a
        if frozenset((low, incoming)) not in merge or kind[low] != kind[high]:
            continue
        few, many = sorted((x, y), key=lambda c: len(members[c]))
        if not members[few].isdisjoint(shunned[many]):
            continue
        for m in members[few]:
            of[m] = low
        if few == low:
            for m in members[many]:
                of[m] = low
        both, no = members[many], shunned[many]
        both.update(members[few])
        no.update(shunned[few])
        for c in (x, y):
            members.pop(c), shunned.pop(c)
        members[low], shunned[low] = both, no
    return of


def partition_components(members: DataFrame, most_members: int = 24, most_weight: int = 42_000) -> DataFrame:
    """(node, component, chunk): components cut into chunks by member count and weight, nodes in order of id. members: node,
    component, weight."""

    def cut(t: pa.Table) -> pa.Table:
        out, chunk, n, w = [], 0, 0, 0
        for node, comp, weight in sorted(zip(*(t.column(c).to_pylist() for c in ("node", "component", "weight")))):
            if n and (n + 1 > most_members or w + weight > most_weight):
                chunk, n, w = chunk + 1, 0, 0
            n, w = n + 1, w + weight
            out.append((node, comp, chunk))
        return pa.table({"node": [o[0] for o in out], "component": [o[1] for o in out], "chunk": pa.array([o[2] for o in out], pa.int32())})

    return members.groupBy("component").applyInArrow(cut, "node string, component string, chunk int")


def validated_plan(plan: DataFrame, refs: DataFrame) -> DataFrame:
    """(ref_id, group_id, status): joint groups must be of one type and two articles at least, and hold each ref once; refs of
    invalid groups, and refs no group holds, become groups of their own."""
    p = plan.join(refs, "ref_id", "left")
    twice = p.groupBy("ref_id").agg(F.count("*").alias("times"))
    bad = p.join(twice, "ref_id").groupBy("group_id").agg((F.max((F.col("kind").isNull() | (F.col("times") > 1)).cast("int")) > 0).alias("broken"), F.count_distinct("kind").alias("kinds"), F.count_distinct("article_id").alias("articles"), F.count("*").alias("n"))
    ok = bad.where("not broken and kinds = 1 and (n = 1 or articles >= 2)").select("group_id")
    kept = plan.join(ok, "group_id").select("ref_id", "group_id", F.lit("kept").alias("status"))
    rest = refs.select("ref_id").join(kept.select("ref_id"), "ref_id", "left_anti").join(plan.select("ref_id").distinct().withColumn("was", F.lit(True)), "ref_id", "left")
    return kept.unionByName(rest.select("ref_id", F.concat(F.lit("single-"), "ref_id").alias("group_id"), F.when(F.col("was"), "demoted").otherwise("added").alias("status")))
