import math
import random

from inkwell.llm import truncation as T

SCHEMA = "record_id long, document_id string, page_idx int, content string, model string, finish_reason string, completion_tokens int, score double, source string"
WORDS = "reservoir levels rose near the harbour while the council reviewed tariffs and school meals before winter".split()


def sentence(rng):
    return " ".join(rng.choice(WORDS) for _ in range(rng.randint(6, 14))).capitalize() + "."


def page(rng):
    return " ".join(sentence(rng) for _ in range(rng.randint(4, 16)))


def test_censored_fit_recovers_the_distribution():
    rng = random.Random(1)
    mu, sd, limit = 6.5, 0.5, 800
    xs = [math.exp(rng.gauss(mu, sd)) for _ in range(20_000)]
    free = [math.log(x) for x in xs if x < limit]
    m, s = T.fit_censored(len(free), sum(free), sum(v * v for v in free), [(limit, len(xs) - len(free))])
    assert abs(m - mu) < 0.02 and abs(s - sd) < 0.02


def test_endings():
    for tail, want in (("All is well.", "stop"), ("并在入冬前完成。", "stop"), ("| a | b |", "item"), ("| a | b", "open"), ("- one\n- two", "item"), ("# Head", "item"), ("it was measu", "mid"), ("it was measu…", "open"), ("see [the report](https://x.ex", "open"), ("Done at last.\n— 13 —", "stop"), ("Done.\nOUTLOOK FOR X Y", "stop"), ("", "empty"), ("  \n", "empty"), ("[3] A title, 1998", "item")):
        assert T.ending(tail, 0, 0, False) == want, tail
    assert T.ending("x = 1", 1, 0, False) == "open" and T.ending("</tr>", 0, 0, True) == "open"


def test_planted_cases(spark):
    rng = random.Random(2)
    rows, cut = [], set()
    for k in range(1500):
        text, doc, idx = page(rng), f"d{k // 6}", k % 6
        tokens = round(len(text) / rng.uniform(3.6, 3.9))
        reason, p = "stop", rng.random()
        if p < 0.05:
            text, cut = text[: int(len(text) * rng.uniform(0.3, 0.8))].rstrip(". ") + "x", cut | {k}
        elif p < 0.1 and len(text) > 700:
            text, cut = text[:600].rstrip(".") + "y" * (600 - len(text[:600].rstrip("."))), cut | {k}
        elif p < 0.13:
            text, tokens, reason, cut = text[: len(text) // 2] + "z", 300, rng.choice(["length", "MAX_TOKENS", "maxTokensReached"]), cut | {k}
        elif p < 0.16:
            text += "\n\n- an item\n- another"
            tokens = round(len(text) / 3.75)
        elif p < 0.18:
            text, tokens = "", 0
        elif p < 0.2:
            tokens = None
        rows.append((k, doc, idx, text, rng.choice(["m1", "m1", "m2"]), reason, tokens, 0.0, "clash"))
    rows += [rows[0], (9001, None, None, None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {r.record_id for r in T.found(df).collect()}
    assert len(got & cut) / len(cut) > 0.97 and len(got & cut) / len(got) > 0.97
    report = {r.model: r for r in T.report(T.scored(df)).collect()}
    assert sum(r.records for r in report.values()) == 1501 and report[""].truncated == 0


def test_a_sentence_that_goes_on_is_no_case(spark):
    full = "The council of Vorn reviewed the tariffs and the school"
    rows = [(1, "d", 0, ("All was quiet. " * 9) + full, "m", "stop", None, 0.0, ""), (2, "d", 1, "meals before winter. All was quiet.", "m", "stop", None, 0.0, ""), (3, "e", 0, ("All was quiet. " * 9) + full, "m", "stop", None, 0.0, ""), (4, "e", 1, "All was quiet. All was quiet. All was quiet. All was well.", "m", "stop", None, 0.0, "")]
    assert {r.record_id for r in T.found(spark.createDataFrame(rows, SCHEMA)).collect()} == {3}


def test_empty(spark):
    assert T.scored(spark.createDataFrame([], SCHEMA)).count() == 0


def silent_cuts(rng):
    """Cuts only the lengths show: at a sentence's end, under a reason that says nothing."""
    rows, by_ratio, by_limit = [], set(), set()
    for k in range(1600):
        text = page(rng)
        tokens = round(len(text) / rng.uniform(3.6, 3.9))
        if k % 20 == 0:
            text, by_ratio = text[: text.find(".", len(text) // 3) + 1], by_ratio | {k}
        elif k % 20 == 1 and len(text) > 700:
            text, tokens, by_limit = text[:640].rsplit(" ", 1)[0] + " ", None, by_limit | {k}
            text = text + "x" * (640 - len(text))
        rows.append((k, f"d{k}", 0, text, "m1", "stop", tokens, 0.0, "s"))
    return rows, {k for k in by_ratio if len(rows[k][3]) < 0.8 * 3.6 * rows[k][6]}, by_limit


def test_the_censored_likelihoods_decide(spark, monkeypatch):
    rows, by_ratio, by_limit = silent_cuts(random.Random(7))
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.record_id for r in T.found(df).collect()}
    assert by_ratio <= got and by_limit <= got and len(got) < 1.1 * len(by_ratio | by_limit) + 10
    real = T.log_likelihoods
    with monkeypatch.context() as m:  # without the survival function against the density
        m.setattr(T, "log_likelihoods", lambda r, e, y, sd, *rest: real(r, e, y * math.nan, sd, *rest[:-1], None) if len(rest) > 4 else real(r, e, y * math.nan, sd, *rest))
        assert not by_ratio & {r.record_id for r in T.found(df).collect()}


def test_the_limit_fit_decides(spark, monkeypatch):
    """Texts at a field limit that end like others: with a constant in place of the fitted ratio the rows change."""
    rng = random.Random(8)
    rows, cut = [], set()
    for k in range(1200):
        text = page(rng)
        if k % 10 == 0 and len(text) > 560:
            text, cut = text[:499].rsplit(" ", 1)[0].ljust(499, "e") + ".", cut | {k}
        rows.append((k, f"d{k}", 0, text, "m1", "stop", None, 0.0, "s"))
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.record_id for r in T.found(df).collect()}
    assert cut <= got and len(got) <= 1.1 * len(cut)
    plain = T.limits
    monkeypatch.setattr(T, "limits", lambda c: plain(c).withColumn("ratio", T.F.lit(-9.0)))
    assert not cut & {r.record_id for r in T.found(df).collect()}


def test_limits_of_many_values_are_all_kept(spark):
    rng = random.Random(9)
    rows = [(k, f"d{k}", 0, "w" * (1000 + 100 * (k % 40)), "m", "length", 100 + 50 * (k % 40), 0.0, "") for k in range(800)]
    assert len({r.record_id for r in T.found(spark.createDataFrame(rows, SCHEMA)).collect()}) == 800
    assert T.limits(spark.createDataFrame([("m", "chars", "alphabet", 1000 + 100 * k, 20) for k in range(40)], "source string, measure string, script string, value int, n long")).count() == 40
