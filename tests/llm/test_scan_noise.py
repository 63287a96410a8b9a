import random

import numpy as np

from inkwell.llm import scan_noise as S

WORDS = "reservoir council reviewed the harbour tariffs school meals before winter north board measured annual levels grant rules near river".split()


def wrapped(rng, n=60, width=50):
    lines, line = [], ""
    for w in [rng.choice(WORDS) for _ in range(n)]:
        if len(line) + len(w) + 1 > width:
            lines.append(line)
            line = w
        else:
            line = f"{line} {w}".strip()
    return "\n".join([*lines, line + "."])


def tables(spark, texts):
    b = spark.createDataFrame([(f"b{k}", "text", t, "clash", 3) for k, t in enumerate(texts)] + [("n", "text", None, "", 1), ("t", "title", "h0use", "", 1)], "block_id string, block_type string, content string, word string, n int")
    p = spark.createDataFrame([(1, "Some reservoir levels.\n\n| a | b |\n| --- | --- |\n\n[1] A reference, 1998"), (2, None), (3, "")], "record_id long, content string")
    x = spark.createDataFrame([(1, "the c0uncil reviewed", ["c0uncil"]), (2, "the council reviewed", ["CO2"]), (3, None, None), (1, "the c0uncil reviewed", ["c0uncil"])], "fragment_id long, text string, source_text_anomalies array<string>")
    return b, p, x


def test_found_and_repaired(spark):
    rng = random.Random(1)
    clean = [wrapped(rng) for _ in range(120)]
    noisy = {
        "misread": clean[0].replace("council", "c0uncil").replace("measured", "mcasured"),
        "broken": clean[1].replace("\n", "\n", 1).replace("reservoir", "reser-\nvoir", 1),
        "unreadable": clean[2].replace("harbour", "harb\ufffdur"),
        "furniture": "\n".join(clean[3].split("\n")[:3] + ["— 17 —", "OUTLOOK FOR VORNIA"] + clean[3].split("\n")[3:]),
    }
    texts = clean[4:] + list(noisy.values()) + ["", " ", "Costs of CO2 and G20, 5 * 3, unit_cost_9.", "word " * 20_000, clean[5]]
    b, p, x = tables(spark, texts)
    rows = S.items(b, p, x)
    out = {(r.item_table, r.item_key): r for r in S.repaired(rows).collect()}
    for k, kind in enumerate(noisy):
        r = out["blocks", f"b{116 + k}"]
        assert kind in r.noise, (kind, r.noise)
        want = " ".join(clean[k].split("\n"))
        assert r.repaired_text == want, kind
    flagged = {k for k, r in out.items() if r.noise}
    assert flagged == {("blocks", f"b{116 + k}") for k in range(4)} | {("excluded_fragments", "1")}
    assert out["excluded_fragments", "1"].repaired_text == "the council reviewed" and out["excluded_fragments", "1"].anomalies_confirmed == 1
    assert out["excluded_fragments", "2"].anomalies_confirmed == 0 and ("blocks", "n") not in out
    assert {tuple(r) for r in S.found(b, p, x).collect()} == flagged


def test_the_vectors_decide_which_rare_words_are_misread(spark):
    """Two rare words are one glyph from a frequent one; only that in the frequent word's company is a misreading."""
    rng = random.Random(3)
    field = "cow barn hay plough tractor meadow".split()
    court = "judge jury verdict appeal lawyer bench".split()
    texts = [" ".join(["the", rng.choice(field), "farm", rng.choice(field), "and", rng.choice(field)] * 6) for _ in range(150)]
    texts += [" ".join(["the", rng.choice(court), "trial", rng.choice(court), "with", rng.choice(court)] * 6) for _ in range(150)]
    texts += ["the cow near farm harn hay and cow", "the plough hench cow barn hay hench meadow tractor", "the judge verdict with jury"]
    rows = spark.createDataFrame([("blocks", f"b{k}", t, None) for k, t in enumerate(texts)], "item_table string, item_key string, text string, anomalies array<string>")
    got = {r.word: list(r.meant) for r in S.learn(rows).suspects.collect()}
    assert got == {"harn": ["barn"]}  # hench stands where bench never does


def test_skip_grams_learn_company():
    counts = np.array([[50, 50, 1, 0], [40, 60, 0, 1], [0, 1, 50, 50], [1, 0, 60, 40]], float)
    w, c = S.skip_grams(counts)
    score = w @ c.T
    assert (score[:2, :2] > score[:2, 2:].max()).all() and (score[2:, 2:] > score[2:, :2].max()).all()


def test_a_hyphen_of_the_word_stays():
    k = S.Knowledge(lexicon={"cross": 90, "border": 90, "reservoir": 90})
    c = S.Cleaner(k)
    assert c.repair("the cross-\nborder line") == "the cross-border line" and "broken" not in c.noise("the cross-\nborder line")
    assert c.repair("the reser-\nvoir line") == "the reservoir line"


def test_vectors_choose_among_candidates(spark):
    k = S.Knowledge(lexicon={"form": 9, "farm": 9}, vectors={"form": [1.0, 0.0], "farm": [0.0, 1.0], "cow": [0.0, 1.0]})
    assert S.Cleaner(k).fits(["form", "farm"], ["cow"]) == "farm" and S.Cleaner(k).fits(["form", "farm"], []) == "form"


def test_empty(spark):
    b = spark.createDataFrame([], "block_id string, block_type string, content string")
    p = spark.createDataFrame([], "record_id long, content string")
    x = spark.createDataFrame([], "fragment_id long, text string, source_text_anomalies array<string>")
    assert S.found(b, p, x).count() == 0
