import random

import pytest

from inkwell.llm import encoding, lexicon, mixing

ODD = ["", None, " ", "\n\n", "naïve café", "𠮷野家 zero\u200bwidth", "a" * 3000, "don't we'll I'd", "مجلس — Совет", "  lead  and trail  ", "1234567", "x\ty\r\nz", "ǅ İ ﬃ", "<|endoftext|>", "👍🏽🏗️"]


def test_transducer_maps_its_words_and_no_others():
    rng = random.Random(1)
    words = sorted({bytes(rng.choices(b"abcd", k=rng.randint(1, 7))) for _ in range(400)})
    ids = [[k, k + 1][: rng.randint(0, 2)] for k in range(len(words))]
    shuffled = list(range(len(words)))
    rng.shuffle(shuffled)
    auto = lexicon.build([words[k] for k in shuffled], [ids[k] for k in shuffled])
    asked = words + [w + b"e" for w in words[:50]] + [b"", b"\xff", words[0][:-1] + b"z"]
    ranks = lexicon.ranks(auto, asked)
    for w, r in zip(asked, ranks):
        if w in words:
            assert auto["ids"][auto["starts"][r] : auto["starts"][r + 1]].tolist() == ids[words.index(w)]
        else:
            assert r == -1
    assert len(auto["finals"]) < sum(map(len, words))  # prefixes and suffixes are shared


def test_empty_transducer():
    assert lexicon.ranks(lexicon.build([], []), [b"a", b""]).tolist() == [-1, -1]


def test_own_merges_equal_the_library():
    tiktoken = pytest.importorskip("tiktoken")
    ranks = encoding.load_ranks(encoding.VOCABULARY)
    enc = tiktoken.Encoding("t", pat_str=encoding.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for word in (" reservoir", "Wärmepläne", "相比之下", "xqzzj", "!!!", " 2004"):
        assert encoding.merge_word(word.encode(), ranks) == enc.encode_ordinary(word)


def test_encode_equals_the_library_and_round_trips(spark):
    tiktoken = pytest.importorskip("tiktoken")
    ranks = encoding.load_ranks(encoding.VOCABULARY)
    enc = tiktoken.Encoding("t", pat_str=encoding.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = [(k, t, "clash", 1, [0]) for k, t in enumerate(ODD + ["repeated words repeated words"] * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string, n int, ids array<int>")
    got = {r.doc_id: list(r.ids) for r in encoding.encode(docs).collect()}
    assert len(got) == len(rows)
    for k, t, *_ in rows:
        assert got[k] == (enc.encode_ordinary(t) if t else [])
        assert encoding.decode(got[k], ranks) == (t or "")
    counts = {r.doc_id: r.n_tokens for r in encoding.encode(docs, counts_only=True).collect()}
    assert counts == {k: len(v) for k, v in got.items()}


def test_encode_empty_table(spark):
    assert encoding.encode(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_mix_reaches_shares_within_repeats(spark):
    rng = random.Random(2)
    rows = [(k, ["Big", " big ", "small", "tiny", None, "unlisted"][min(5, int(rng.expovariate(0.9)))], rng.randint(1, 60), 7) for k in range(4000)]
    sized = spark.createDataFrame(rows, "doc_id long, source string, n_tokens long, key int")
    targets = spark.createDataFrame([("BIG", 0.5, 1), ("small", 0.3, 3), ("tiny", 0.2, 2), ("absent", 0.0, 5)], "source string, target_share double, max_repeats int")
    mixed = mixing.mix(sized, targets).cache()
    out = {r.source: r for r in mixing.shares(mixed, targets).collect()}
    assert all(abs(out[s].actual_share - t) < 0.01 for s, t in (("big", 0.5), ("small", 0.3), ("tiny", 0.2)))
    assert out["absent"].tokens == 0 and out["absent"].actual_share == 0
    most = {"big": 1, "small": 3, "tiny": 2}
    assert all(1 <= r.repeats <= most[r.source] for r in mixed.collect())
    assert mixed.select("doc_id").distinct().count() == mixed.count()
    again = mixing.mix(sized.repartition(3), targets)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, mixed.collect()))  # the order of delivery doesn't matter


def test_mix_with_a_fixed_total_reports_what_is_short(spark):
    sized = spark.createDataFrame([(1, "a", 10), (2, "b", 10), (3, "b", None), (4, "b", 0)], "doc_id long, source string, n_tokens long")
    targets = spark.createDataFrame([("a", 0.5, 2), ("b", 0.5, 9)], "source string, target_share double, max_repeats int")
    out = {r.source: (r.repeats) for r in mixing.mix(sized, targets, total=100).collect()}
    assert out == {"a": 2, "b": 5}


def test_mix_empty(spark):
    sized = spark.createDataFrame([], "doc_id long, source string, n_tokens long")
    targets = spark.createDataFrame([("a", 1.0, 2)], "source string, target_share double, max_repeats int")
    assert mixing.mix(sized, targets).count() == 0
    assert mixing.shares(mixing.mix(sized, targets), targets).first().actual_share == 0
