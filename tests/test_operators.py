"""Expected values for small fixtures, and the defined results of empty and odd inputs."""

import hashlib
import math
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from inkwell.functions import text as X
from inkwell.operators import claims, metrics, records, resolve, retrieval, structure, units, versioning


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols or df.columns) for r in df.collect())


def test_retrieval_metrics_of_alternative_sets(spark):
    gold = spark.createDataFrame([("q", 1, "A"), ("q", 1, "B"), ("q", 2, "C"), ("none", 1, "Z")], "question_id string, set_id int, atom_id string")
    ranked = spark.createDataFrame([("q", 1, ["X"]), ("q", 2, ["A", "B"])], "question_id string, rank int, atoms array<string>")
    one = {r.question_id: r for r in metrics.atom_metrics(ranked, gold, 1).collect()}
    two = {r.question_id: r for r in metrics.atom_metrics(ranked, gold, 2).collect()}
    assert one["q"].recall == 0 and one["q"].mrr == 0 and two["q"].recall == 1 and two["q"].complete == 1 and two["q"].mrr == 0.5
    assert abs(two["q"].precision - 2 / 3) < 1e-9
    dcg = 3 / math.log2(3) + 3 / math.log2(4)
    assert abs(two["q"].ndcg - dcg / (3 + 3 / math.log2(3) + 3 / math.log2(4))) < 1e-9
    assert two["none"].recall == 0 and two["none"].ndcg == 0


def test_fusion_breaks_ties_by_id(spark):
    lists = spark.createDataFrame([("q", "b", 1), ("q", "a", 2), ("q", "a", 1), ("q", "b", 2)], "question_id string, unit_id string, rank int")
    assert rows(retrieval.fuse(lists), "rank", "unit_id") == [(1, "a"), (2, "b")]


def test_bm25_keeps_repeats_and_pads(spark):
    u = spark.createDataFrame([("t1", "financial policy rules"), ("t2", "school meals"), ("t3", "policy policy"), ("t4", "")], "unit_id string, retrieval_text string")
    q = spark.createDataFrame([("q1", "policy"), ("q2", "policy policy"), ("q3", "nothing here"), ("q4", "")], "question_id string, question string")
    s = {(r.question_id, r.unit_id): r.score for r in retrieval.bm25(retrieval.postings(u), q).collect()}
    assert s["q2", "t3"] == pytest.approx(2 * s["q1", "t3"]) and ("q3", "t1") not in s
    idf, avg = math.log(1 + (3 - 2 + 0.5) / 2.5), 7 / 3
    assert s["q1", "t1"] == pytest.approx(idf * 2.5 / (1 + 1.5 * (0.25 + 0.75 * 3 / avg)))
    padded = retrieval.top_k(retrieval.zero_padded(retrieval.bm25(retrieval.postings(u), q), q, u, 3), 3)
    assert rows(padded.where("question_id = 'q3'"), "rank", "unit_id") == [(1, "t1"), (2, "t2"), (3, "t3")]


def test_blocked_bm25_equals_the_full_sums(spark):
    rng = random.Random(7)
    words = [f"w{min(int(rng.expovariate(0.05)), 400)}" for _ in range(6000)] + ["the"] * 2500 + ["of"] * 1500
    rng.shuffle(words)
    u = spark.createDataFrame([(f"u{k:04}", " ".join(words[k * 12 : k * 12 + rng.randint(1, 12)])) for k in range(800)], "unit_id string, retrieval_text string")
    q = spark.createDataFrame([(f"q{k}", " ".join(rng.choice(words) for _ in range(rng.randint(1, 6)))) for k in range(40)] + [("e", ""), ("x", "unknown"), ("n", None)], "question_id string, question string")
    post = retrieval.postings(u)
    for k in (1, 5, 30):
        want = rows(retrieval.top_k(retrieval.bm25(post, q), k).select("question_id", "rank", "unit_id", F.round("score", 6)))
        assert rows(retrieval.top_k(retrieval.bm25_top_k(u, q, k), k).select("question_id", "rank", "unit_id", F.round("score", 6))) == want


def test_cosine_equals_brute_force(spark):
    rng = random.Random(1)
    v = [(k, [rng.gauss(0, 1) for _ in range(8)]) for k in range(80)] + [(80, [0.0] * 8), (81, None)]
    v[5] = (5, v[4][1])
    df = spark.createDataFrame([x for x in v if x[1]], "vec_id long, embedding array<double>").repartition(5)
    got = {(r.question_id, r.rank): (r.unit_id, r.score) for r in retrieval.cosine_top_k(df, df.where("vec_id % 20 = 0"), 7).collect()}
    vs = dict(x for x in v if x[1])

    def cos(a, b):
        n = math.hypot(*a) * math.hypot(*b)
        return sum(x * y for x, y in zip(a, b)) / n if n else 0.0

    for q in (0, 20, 40, 60, 80):
        want = sorted(((-round(cos(vs[q], vs[k]), 9), k) for k in vs if k != q))[:7]
        assert [got[q, i + 1][0] for i in range(7)] == [k for _, k in want]


def test_greedy_packing_and_context(spark):
    a = spark.createDataFrame([("d", k, n) for k, n in enumerate([500, 500, 300, 2000, 10, 1190])], "article_id string, pos int, n int")
    assert [g for _, g in rows(units.pack(a, ["article_id"], "pos", "n", F.lit(1200), "g"), "pos", "g")] == [0, 0, 1, 2, 3, 4]
    ranked = spark.createDataFrame([("q", 1, "u1", "c1", 60), ("q", 2, "u2", "c2", 90), ("q", 3, "u3", "c2", 10), ("q", 4, "u4", "c1", 60), ("q", 5, "u5", "c5", 38)], "question_id string, rank int, unit_id string, context_id string, n int")
    r = units.pack_context(ranked, 100).first()
    assert r.unit_ids == ["u1", "u5"] and r.token_count == 100 and r.skipped == ["u2"]


def test_clusters(spark):
    def run(edges):
        df = spark.createDataFrame([(f"e{k}", *e) for k, e in enumerate(edges)], "edge_id string, left_ref string, right_ref string, decision string")
        return rows(resolve.constrained_clusters(df), "node", "cluster")

    assert run([("a", "b", "same"), ("b", "c", "related")]) == [("a", "a"), ("b", "a"), ("c", "c")]
    assert run([("a", "b", "same"), ("b", "c", "same")]) == [("a", "a"), ("b", "a"), ("c", "c")]  # the representative wasn't judged with c
    assert run([("a", "b", "same"), ("a", "c", "same"), ("b", "c", "separate")]) == [("a", "a"), ("b", "a"), ("c", "c")]


def naive_clusters(edges):
    """Straight from the rule: edges (left, right, decision, kinds) in order; clusters as sets searched anew each time."""
    nodes = sorted({x for e in edges for x in e[:2]})
    kind = {}
    for a, b, _, ka, kb in edges:
        kind.setdefault(a, ka), kind.setdefault(b, kb)
    groups = [{x} for x in nodes]
    merge = {frozenset(e[:2]) for e in edges if e[2] in ("same", "complementary")}
    apart = {frozenset(e[:2]) for e in edges if e[2] == "separate"}
    for a, b, decision, _, _ in edges:
        left, right = (next(g for g in groups if x in g) for x in (a, b))
        if decision not in ("same", "complementary") or left is right:
            continue
        smallest = min(left | right)
        other_end = b if smallest in left else a
        if frozenset((smallest, other_end)) not in merge:
            continue
        if any(frozenset((x, y)) in apart or kind[x] != kind[y] for x in left for y in right):
            continue
        groups = [g for g in groups if g is not left and g is not right] + [left | right]
    return {x: min(g) for g in groups for x in g}


def test_the_edges_own_end_must_be_judged_with_the_smallest_member():
    edges = [("a", "b", "same"), ("c", "d", "same"), ("b", "c", "same"), ("c", "e", "same"), ("d", "f", "same"), ("a", "d", "same"), ("e", "f", "separate"), ("b", "d", "related")]
    full = [(f"e{k}", *e, "T", "T") for k, e in enumerate(edges)]
    assert resolve.fold(full) == naive_clusters([e[1:] for e in full])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abcdefg"), st.sampled_from("abcdefg"), st.sampled_from(["same", "same", "complementary", "related", "separate"])).filter(lambda e: e[0] != e[1]), max_size=22), st.dictionaries(st.sampled_from("abcdefg"), st.sampled_from("TTTP")))
def test_clusters_equal_the_rule(edges, kinds):
    full = [(f"e{k:02}", a, b, d, kinds.get(a, "T"), kinds.get(b, "T")) for k, (a, b, d) in enumerate(edges)]
    assert resolve.fold(full) == naive_clusters([e[1:] for e in full])


def test_clusters_over_components(spark):
    import random

    rng = random.Random(4)
    edges = []
    for k in range(300):
        c = rng.randrange(30)
        a, b = rng.sample(range(7), 2)
        edges.append((f"e{k:03}", f"{c:02}{'abcdefg'[a]}", f"{c:02}{'abcdefg'[b]}", rng.choice(["same", "same", "complementary", "related", "separate"]), "T", "T"))
    df = spark.createDataFrame(edges, "edge_id string, left_ref string, right_ref string, decision string, left_kind string, right_kind string").repartition(4)
    assert dict(rows(resolve.constrained_clusters(df), "node", "cluster")) == naive_clusters([e[1:] for e in edges])


def test_components_of_a_long_chain(spark):
    e = spark.createDataFrame([(f"n{k:03}", f"n{k + 1:03}") for k in range(120) if k != 60], "left_ref string, right_ref string")
    got = dict(rows(resolve.components(e), "node", "component"))
    assert got["n060"] == "n000" and got["n120"] == "n061" and len(got) == 121


def test_component_chunks(spark):
    m = spark.createDataFrame([(f"n{k:02}", "c", 1000) for k in range(50)], "node string, component string, weight int")
    assert [c for _, c in rows(resolve.partition_components(m, 24, 42_000), "node", "chunk")] == [0] * 24 + [1] * 24 + [2] * 2


def test_candidate_edges_stop_at_the_best(spark):
    r = spark.createDataFrame([("a", "T", "1", "harbour tariff rules"), ("b", "T", "2", "harbour tariff table"), ("c", "T", "3", "school meals"), ("d", "P", "4", "harbour tariff rules"), ("e", "T", "1", "harbour tariff rules"), ("n", "T", "5", None)], "ref_id string, kind string, article_id string, text string")
    assert rows(resolve.candidate_edges(r, top=1), "left_ref", "right_ref") == [("a", "b"), ("b", "e")]


def test_reconcile(spark):
    old = spark.createDataFrame([("k", "x"), ("k", "x"), ("k", "y"), ("gone", "z")], "key string, c string")
    new = spark.createDataFrame([("k", "x"), ("k", "w"), ("k", "v"), ("fresh", "z")], "key string, c string")
    assert rows(versioning.reconcile(old, new, "key", "c")) == [("fresh", "added"), ("gone", "not_repeated"), ("k", "revised"), ("k", "revised"), ("k", "unchanged")]
    assert versioning.reconcile(old.limit(0), new.limit(0), "key", "c").count() == 0


def test_scope_relations(spark):
    t = "struct<lo:int,hi:int>"
    df = spark.createDataFrame([((2000, 2004), (2003, 2005), ["x"], ["x"], "same"), ((2000, 2001), (2003, 2005), ["x"], ["x"], "temporal_variant"), ((2000, 2004), (2003, 2005), ["x"], ["y"], "scenario_variant"), (None, None, [], [], "unknown"), ((2000, 2004), None, [], ["y"], "overlap")], f"a {t}, b {t}, p array<string>, q array<string>, want string")
    assert all(r.want == r.got for r in df.withColumn("got", versioning.scope_relation(F.col("a"), F.col("b"), F.col("p"), F.col("q"))).collect())


def test_coverage_and_decision(spark):
    c = spark.createDataFrame([("g", 1), ("g", 2), ("h", 1), ("i", 1)], "g string, claim int")
    r = spark.createDataFrame([("g", 1, "covered", 1), ("g", 1, "contradicted", 2), ("g", 1, "contradicted", 3), ("g", 2, "uncertain", 1), ("h", 1, "covered", 4)], "g string, claim int, status string, batch int")
    m = versioning.worst_status(c, r, ["g", "claim"])
    assert rows(m.fillna(0)) == [("g", 1, "contradicted", 2), ("g", 2, "uncertain", 1), ("h", 1, "covered", 4), ("i", 1, "omitted", 0)]
    assert rows(versioning.review_decision(m, "g"), "g", "decision") == [("g", "human_review"), ("h", "pass"), ("i", "recompile")]


def test_answer_and_citation_scores(spark):
    req = spark.createDataFrame([("q", "f1", 2.0, True), ("q", "f2", 1.0, False)], "question_id string, fact_id string, weight double, critical boolean")
    forb = spark.createDataFrame([("q", "x1")], "question_id string, fact_id string")
    q = spark.createDataFrame([("q", True, True), ("u", False, False)], "question_id string, answerable boolean, predicted_answerable boolean")

    def score(*facts):
        c = spark.createDataFrame([("q", f) for f in facts] or [], "question_id string, fact_id string")
        return {r.question_id: r for r in claims.answer_scores(req, forb, c, q).collect()}

    r = score("f1")
    assert r["q"].fact_recall == pytest.approx(2 / 3) and r["q"].fact_precision == 1 and r["q"].correct and r["u"].correct and r["u"].fact_recall is None
    assert not score("f2")["q"].correct and not score("f1", "x1")["q"].correct and score("f1", "zz")["q"].fact_precision == pytest.approx(2 / 3)
    cit = spark.createDataFrame([("q", "A"), ("q", "A"), ("q", "gone")], "question_id string, atom_id string")
    gold = spark.createDataFrame([("q", 1, "A")], "question_id string, set_id int, atom_id string")
    uni = spark.createDataFrame([("A",), ("B",)], "atom_id string")
    c = {r.question_id: r for r in claims.citation_scores(cit, gold, uni, q).collect()}
    assert c["q"].validity == pytest.approx(2 / 3) and c["q"].precision == 0.5 and c["q"].complete and c["u"].validity == 1 and c["u"].precision is None


def test_bootstrap(spark):
    p = spark.createDataFrame([("a", 0.2), ("b", 0.2), ("c", 0.2)], "id string, d double")
    r = metrics.bootstrap(p, 40).first()
    assert (r.n, round(r["mean"], 9), round(r.low, 9), round(r.high, 9)) == (3, 0.2, 0.2, 0.2)
    assert metrics.bootstrap(p.limit(0), 5).count() == 0
    assert rows(metrics.number_rows(spark.range(100).withColumnRenamed("id", "k"), "k", 4), "k", "i") == [(k, k) for k in range(100)]


def resampled(ds, samples):
    """Mean, 2.5 and 97.5 percentiles of the resampled means, draw by draw."""
    n, means = len(ds), []
    for s in range(samples):
        means.append(math.fsum(ds[int(hashlib.sha256(f"42:{s}:{k}".encode()).hexdigest()[:15], 16) % n] for k in range(n)) / n)
    means.sort()
    at = [p * (samples - 1) for p in (0.025, 0.975)]
    return math.fsum(ds) / n, *[means[math.floor(x)] + (means[math.ceil(x)] - means[math.floor(x)]) * (x % 1) for x in at]


def test_bootstrap_draws_ten_thousand_resamples(spark, monkeypatch):
    ds = [0.0, 0.0, 1.0, -0.25, 0.5, 0.125, 0.0, 3.0, 0.75]
    p = spark.createDataFrame([(k, v) for k, v in enumerate(ds)], "id int, d double")
    r = metrics.bootstrap(p).first()
    assert tuple(r)[1:] == pytest.approx(resampled(ds, 10_000), abs=1e-9) and r.n == 9
    near = tuple(metrics.bootstrap(p, 300).first())
    monkeypatch.setattr(metrics, "REPLICATED", 0)
    assert tuple(metrics.bootstrap(p, 300).first()) == pytest.approx(near, abs=1e-9)


def test_paired_bootstrap_query_compares_two_arms(spark):
    from inkwell.plans import base, retrieval_queries as Q

    d = "/root/testdata/sf0.001"
    gold, a = base.gold(spark, d), base.atoms(spark, d)
    t0, t1 = ({r.question_id: r.recall_10 for r in metrics.unit_metrics(Q.ranked_atoms(spark, d, u), gold).collect()} for u in (units.fixed_chunks(a), units.parent_child(a)))
    ds = [t1[q] - t0[q] for q in sorted(t0.keys() & t1.keys())]
    r = Q.Q["q184_paired_bootstrap"][0](spark, d).first()
    assert r.n == len(ds) > 1 and (r["mean"], r.low, r.high) == pytest.approx(resampled(ds, 10_000), abs=1e-5)


def test_heading_stack_and_extent(spark):
    b = spark.createDataFrame([("d", k, 0, k, t, lv, c) for k, (t, lv, c) in enumerate([("title", 1, "A"), ("text", None, "x"), ("title", 2, "B"), ("title", 3, "C"), ("text", None, "y"), ("title", 2, "D"), ("title", 9, "E"), ("text", None, None)])], "document_id string, block_id long, page_idx int, reading_order int, block_type string, heading_level int, content string")
    got = [r.running_path for r in structure.heading_stack(b).orderBy("pos").collect()]
    assert got == [["A"], ["A"], ["A", "B"], ["A", "B", "C"], ["A", "B", "C"], ["A", "D"], ["E"], ["E"]]
    assert rows(structure.section_extent(b), "pos", "end_pos") == [(1, 6), (3, 5), (4, 5), (6, 6), (7, 8)]
    assert structure.heading_stack(b.limit(0)).count() == 0


def test_segments(spark):
    b = spark.createDataFrame([("d", k, n, h) for k, (n, h) in enumerate([(10, True), (600, False), (600, False), (100, False), (900, True), (900, False)])], "document_id string, pos int, n int, h boolean")
    assert [s for _, s in rows(claims.segments(b, "document_id", "pos", "n", F.col("h"), 1000, 1500), "pos", "segment")] == [0, 0, 0, 1, 2, 3]


def test_text_functions(spark):
    df = spark.createDataFrame([("The 2004 plan 《水利》规划, 30%", "第一章 总则", "a/b: C?", "<td>x &amp; y</td>", "Outlook ..... 12")], "t string, h string, s string, c string, toc string")
    title, page = claims.toc_line(F.col("toc"))
    r = df.select(X.term_set(F.col("t")).alias("terms"), X.hard_anchors(F.col("t")).alias("anchors"), X.heading_style(F.col("h")).alias("style"), X.slug(F.col("s")).alias("slug"), X.strip_tags(F.col("c")).alias("cell"), title.alias("title"), page.alias("page"), X.year_interval(F.col("t")).alias("y"), claims.render("{t}:{n}", {"t": F.col("h"), "n": F.lit(None)}).alias("tpl"), claims.pixel_box(F.array(F.lit(0.0), F.lit(0.5), F.lit(0.25), F.lit(1.0)), F.lit(200), F.lit(100)).alias("box")).first()
    assert r.terms == ["2004", "30", "plan", "水利", "规划"] and r.anchors == ["2004", "《水利》", "30%"]
    assert (r.style, r.slug, r.cell, r.title, r.page, tuple(r.y)) == ("chapter", "a-b-c", "x & y", "Outlook", 12, (2004, 2004))
    assert r.tpl == "第一章 总则:" and r.box == [0, 50, 50, 100]
    with pytest.raises(KeyError):
        claims.render("{nope}", {})


def test_records(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), ("m", None, "c")], "key string, at int, v string")
    assert rows(records.latest(df, "key", "at"), "key", "v") == [("k", "b"), ("m", "c")]
    w = spark.createDataFrame([("a", "f"), ("b", "f"), ("c", "f"), ("d", "f")], "key string, fingerprint string")
    s = spark.createDataFrame([("a", "f", True), ("b", "g", True), ("c", "f", False)], "key string, fingerprint string, complete boolean")
    assert [x[1] for x in rows(records.needs_compile(w, s, "key"), "key", "action")] == ["reuse", "changed", "incomplete", "new"]


def test_plan_validation(spark):
    refs = spark.createDataFrame([("a", "T", "1"), ("b", "T", "2"), ("c", "P", "3"), ("d", "T", "1"), ("e", "T", "9")], "ref_id string, kind string, article_id string")
    plan = spark.createDataFrame([("a", "g1"), ("b", "g1"), ("c", "g2"), ("d", "g2"), ("zz", "g3")], "ref_id string, group_id string")
    assert rows(resolve.validated_plan(plan, refs)) == [("a", "g1", "kept"), ("b", "g1", "kept"), ("c", "single-c", "demoted"), ("d", "single-d", "demoted"), ("e", "single-e", "added")]


def test_pipeline_stages_and_resume(spark):
    from inkwell.plans import hybrid

    u = spark.createDataFrame([(f"u{k}", t, t, f"c{k}") for k, t in enumerate(["harbour tariff rules", "school meals", "harbour school", "tariff tariff"])], "unit_id string, retrieval_text string, context_text string, context_id string")
    q = spark.createDataFrame([("q1", "tariff rules"), ("q2", "school")], "question_id string, question string")
    c = hybrid.Config(sparse_k=3, rerank_k=2, context_budget=25)
    t = hybrid.trace(q, u, config=c)
    assert {r[0] for r in t.select("stage").distinct().collect()} == {"sparse", "dense", "fused", "reranked"}
    assert rows(t.where("stage = 'reranked' and rank = 1"), "question_id", "unit_id") == [("q1", "u0"), ("q2", "u1")]
    assert {r.question_id: r.unit_ids for r in hybrid.contexts(t, u, config=c).collect()}["q1"] == ["u0"]
    whole = hybrid.experiment(q, {"A": u, "B": u}, config=c).cache()
    rest = hybrid.experiment(q, {"A": u, "B": u}, done=whole.where("arm = 'A'"), config=c)
    assert {(r.arm, r.question_id) for r in rest.collect()} == {("B", "q1"), ("B", "q2")}
    assert hybrid.Config(rrf_k=10).fingerprint() != c.fingerprint()


def test_chunks_packed_as_they_pass_equal_the_joined_ones(spark):
    rng = random.Random(3)
    a = [(f"d{k // 400 if k < 800 else k}", k, " \n ".join(rng.choice(("Ab", "ΑΣ", "word", "长词", "x" * 1300)) for _ in range(rng.choice((1, 3, 40, 300))))) for k in range(1000)]
    a = spark.createDataFrame(a, "article_id string, pos int, text string").withColumn("n", F.char_length("text"))
    a = a.withColumn("pos", F.row_number().over(Window.partitionBy("article_id").orderBy("pos"))).withColumn("atom_id", F.col("pos").cast("string")).withColumn("page", F.lit(1))

    def postings(blocks):
        out = []
        for r in blocks.collect():
            for n, term in enumerate(r.terms):
                out += [(r.ids[i], r.dl[i], term, tf) for i, tf in zip(r["at"][r.starts[n] : r.starts[n + 1]], r.tf[r.starts[n] : r.starts[n + 1]])]
        return sorted(out)

    want = postings(retrieval.unit_blocks(units.fixed_chunks(a)))
    assert len({x[0] for x in want}) > 500
    for size in ("3", "10000"):  # units that go over an end of a batch, and none
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            assert postings(retrieval.chunk_blocks(a)) == want
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert retrieval.chunk_blocks(a.where("false")).count() == 0


def test_blocks_give_the_full_sums_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(retrieval, "UNIT_BLOCK", 64)
    monkeypatch.setattr(retrieval, "QUESTION_BLOCK", 16)
    rng = random.Random(9)
    words = [f"w{min(int(rng.expovariate(0.05)), 300)}" for _ in range(5000)] + ["the"] * 2000
    u = spark.createDataFrame([(f"u{k:04}", " ".join(rng.choice(words) for _ in range(rng.randint(0, 12)))) for k in range(700)], "unit_id string, retrieval_text string").coalesce(1)
    q = spark.createDataFrame([(f"q{k}", " ".join(rng.choice(words) for _ in range(rng.randint(1, 6)))) for k in range(60)] + [(None, "the w1"), ("e", ""), ("n", None)], "question_id string, question string")
    key = lambda r: (r.question_id or "", r["rank"], r.unit_id, round(r.score, 6))
    for k in (1, 10):
        want = sorted(map(key, retrieval.top_k(retrieval.bm25(retrieval.postings(u), q), k).collect()))
        assert sorted(map(key, retrieval.top_k(retrieval.bm25_top_k_of_blocks(retrieval.unit_blocks(u), q, k), k).collect())) == want


def test_expanded_questions_shuffle_no_score_of_each_pair(spark):
    from inkwell import catalogue

    df = catalogue.queries()["q176_expanded_questions"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(question_id#\d+, unit_id", plan) and "MapInArrow" in plan
