import random

import numpy as np

from inkwell.llm import repetition as R, trees
from inkwell.llm.windows import normalised


def brute(t, w=30):
    seen, marked = set(), set()
    for i in range(len(t) - w + 1):
        if t[i : i + w] in seen:
            marked |= set(range(i, i + w))
        seen.add(t[i : i + w])
    return len(marked) / len(t) if t else 0.0


def docs(rng, n):
    out = []
    for _ in range(n):
        sents = [" ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(rng.randint(4, 12))) + ". " for _ in range(rng.randint(1, 12))]
        t = "".join(sents)
        if rng.random() < 0.5:
            t += rng.choice(sents) * rng.randint(1, 10)
        if rng.random() < 0.2:
            t += "相比之下，" * rng.randint(1, 30)
        out.append(t)
    return out


def test_exact_share_equals_the_definition():
    for t in docs(random.Random(1), 300) + ["", "x", "a" * 31, "a" * 500, "ab" * 40]:
        t = normalised(t)
        assert abs(R.exact_share(t) - brute(t)) < 1e-12


def test_trees_are_monotone_and_accurate():
    rng = random.Random(2)
    texts = [normalised(t) for t in docs(rng, 900)]
    x = R.features(texts)
    y = (x[:, 0] >= R.THRESHOLD).astype(float)
    model = trees.fit(x[:600], y[:600], R.RISING, cuts={0: [float(np.nextafter(R.THRESHOLD, 0.0))]})
    p = trees.predict(model, x[600:])
    assert ((p >= R.DECIDES) == (y[600:] == 1)).all()
    for f in R.RISING:
        up = x[600:].copy()
        up[:, f] += 0.2
        assert (trees.predict(model, up) >= p - 1e-9).all()


def test_the_trees_tell_repetition_without_the_share():
    """Held out, from the other statistics alone: the trees are more than the threshold."""
    texts = [normalised(t) for t in docs(random.Random(6), 1500)]
    x = R.features(texts)
    y = (x[:, 0] >= R.THRESHOLD).astype(float)
    p = trees.predict(trees.fit(x[:1000, 1:], y[:1000], {0, 1, 2}), x[1000:, 1:])
    assert ((p >= R.DECIDES) == (y[1000:] == 1)).mean() > 0.95


def test_the_trees_select_the_rows(spark):
    blocks = spark.createDataFrame([(f"b{k}", "text", t) for k, t in enumerate(docs(random.Random(4), 120))], "block_id string, block_type string, content string")
    pages = spark.createDataFrame([], "record_id long, content string")
    rows = R.found(blocks, pages).count()
    never = R.fit_model(R.items(blocks, pages))
    never["value"] = never["value"] * 0
    never["base"] = np.array(0.0)
    assert rows > 10 and R.found(blocks, pages, model=never).count() == 0


def test_shares_over_tables(spark):
    rng = random.Random(3)
    rows = [(f"b{k}", "text", t) for k, t in enumerate(docs(rng, 150))] + [("n", "text", None), ("e", "text", ""), ("w", "text", " \n "), ("l", "text", "long words here and there " * 4000), ("h", "title", "x " * 90)]
    rows.append(rows[0])
    blocks = spark.createDataFrame([(*r, 1.0, "s") for r in rows], "block_id string, block_type string, content string, score double, item_key string")
    pages = spark.createDataFrame([(7, "spam spam spam and more spam " * 20), (8, None)], "record_id long, content string")
    out = {(r.item_table, r.item_key): r.repeated_share for r in R.repeated_share(R.items(blocks, pages)).collect()}
    assert len(out) == 153 + 1
    for k, kind, t in rows:
        if kind == "text" and t is not None:
            got, want = out["blocks", k], brute(normalised(t)) if len(t) < 50_000 else 1.0
            assert abs(got - want) < 1e-9 or k == "l" and got > 0.99
    found = {tuple(r) for r in R.found(blocks, pages).collect()}
    assert found == {k for k, v in out.items() if v is not None and v >= 0.4} and ("page_results", "7") in found


def test_empty(spark):
    b = spark.createDataFrame([], "block_id string, block_type string, content string")
    p = spark.createDataFrame([], "record_id long, content string")
    assert R.found(b, p).count() == 0


def test_p3_shares_gives_every_text_its_share(spark, tmp_path):
    from inkwell.llm import queries

    rows = [(f"b{k}", "text", t) for k, t in enumerate(docs(random.Random(5), 120))] + [("e", "text", ""), ("s", "text", "short"), ("n", "text", None)]
    spark.createDataFrame(rows, "block_id string, block_type string, content string").write.parquet(f"{tmp_path}/blocks.parquet")
    page = "a line said twice, and both times alike. " * 2 + " ".join(str(k) for k in range(900))
    spark.createDataFrame([(7, page), (8, None)], "record_id long, content string").write.parquet(f"{tmp_path}/page_results.parquet")
    want = {("blocks", k): brute(normalised(t)) for k, _, t in rows if t is not None} | {("page_results", "7"): brute(normalised(page))}
    assert any(0 < v < 0.15 for v in want.values())
    out = {(r.item_table, r.item_key): r for r in queries.p3_shares(spark, str(tmp_path)).collect()}
    assert out.keys() == want.keys() and all(abs(out[k].repeated_share - v) < 1e-12 for k, v in want.items())
    assert any(r.score < R.DECIDES and r.n_chars > R.WIDTH for r in out.values())
