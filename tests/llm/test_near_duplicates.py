import random

from inkwell.llm import near_duplicates as N
from inkwell.llm.windows import normalised, window_hashes

WORDS = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "pe", "ra", "so", "tu") for b in ("bel", "dor", "fin", "gan", "hul", "jim", "kor", "lam", "mon", "nis")]


def text(rng, n=60):
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 99)) for _ in range(n))


def brute(rows, least=200, t=0.6):
    kept = {k: N.substrings(normalised(x), 12) for k, x in rows if x and len(normalised(x)) >= least}
    keys = sorted(kept)
    return {(a, b) for i, a in enumerate(keys) for b in keys[i + 1 :] if len(kept[a] & kept[b]) / len(kept[a] | kept[b]) >= t}


def corpus(rng):
    rows = []
    for g in range(60):
        base = text(rng)
        rows.append((f"a{g:03}", base))
        for c in range(rng.randint(0, 4)):
            words = base.split()
            for _ in range(rng.randint(0, 6)):
                words[rng.randrange(len(words))] = rng.choice(WORDS)
            if rng.random() < 0.3:
                words = words[15:] + words[:15]
            rows.append((f"a{g:03}x{c}", " ".join(words).upper() if rng.random() < 0.2 else "  ".join(words)))
    return rows


def test_bk_tree_equals_a_scan():
    rng = random.Random(3)
    codes = [rng.getrandbits(64) for _ in range(300)]
    codes += [c ^ (1 << rng.randrange(64)) for c in codes[:100]] + codes[:20]
    tree = N.BKTree()
    for k, c in enumerate(codes):
        tree.add(c, k)
    for c in codes[:60]:
        for radius in (0, 3, 24):
            assert sorted(tree.within(c, radius)) == [k for k, x in enumerate(codes) if (x ^ c).bit_count() <= radius]


def test_the_tree_decides_within_coarse_shards(spark, monkeypatch):
    """Texts around one phrase share shards; the tree alone keeps them from the exact comparison."""
    rng = random.Random(11)
    phrase = text(rng, 17)
    rows = [(f"p{k:03}", phrase + " " + text(rng, 27)) for k in range(300)]
    df = spark.createDataFrame(rows, "block_id string, content string").repartition(2)
    coded = N.checkpoint(N.coded(df, "block_id", "content", 200, 12))
    kept = N.candidates(coded, 200).count()
    monkeypatch.setattr(N, "RADIUS", N.BITS)
    without = N.candidates(coded, 200).count()
    assert without > 1_000 and kept < 0.25 * without
    monkeypatch.setattr(N, "RADIUS", -1)
    assert N.candidates(coded, 200).count() == 0


def test_copies_of_a_hot_class_meet_in_parts(spark, monkeypatch):
    rng = random.Random(12)
    base, near = text(rng), None
    near = base.split()
    near[3] = "changed"
    rows = [(f"c{k:03}", base) for k in range(60)] + [("n1", " ".join(near)), ("n2", " ".join(near)), ("o", text(rng))]
    monkeypatch.setattr(N, "COPIES", 7)
    got = [(r.left, r.right) for r in N.similar_pairs(spark.createDataFrame(rows, "block_id string, content string")).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows)


def test_atoms_are_in_the_groups_of_their_blocks(spark):
    rng = random.Random(13)
    t = text(rng)
    blocks = spark.createDataFrame([("b1", "text", t), ("b2", "text", t + " more"), ("b3", "title", t)], "block_id string, block_type string, content string")
    atoms = spark.createDataFrame([("d:p001:bb1", "text", t.strip()), ("d:p001:bb2", "text", t + " more")], "atom_id string, block_type string, text string")
    out = {(r.item_table, r.item_key): r.group_id for r in N.block_groups(blocks, atoms).collect()}
    assert set(out) == {("blocks", "b1"), ("blocks", "b2"), ("evidence_atoms", "d:p001:bb1"), ("evidence_atoms", "d:p001:bb2")} and len(set(out.values())) == 1


def test_windows_hash_equal_exactly_for_equal_windows():
    texts = ["abcabcabc", "xxabc", "", "ab"]
    h, doc, pos = window_hashes(texts, 3)
    seen = {}
    for x, d, p in zip(h.tolist(), doc.tolist(), pos.tolist()):
        assert seen.setdefault(texts[d][p : p + 3], x) == x
    assert len(set(seen.values())) == len(seen) and len(h) == 7 + 3


def test_pairs_equal_brute_force(spark):
    rows = corpus(random.Random(4))
    rows += [("n1", None), (None, rows[0][1]), ("e", ""), ("b", "   "), rows[0], ("copy", rows[0][1]), ("short", "abc")]
    df = spark.createDataFrame([(k, t, "c", 1, 2, 0.5) for k, t in rows], "block_id string, content string, cls string, a int, key int, text double").repartition(5)
    got = {(r.left, r.right) for r in N.similar_pairs(df).collect()}
    assert got == brute([r for r in dict(x for x in rows if x[0]).items()])


def test_a_hot_shard_is_cut_into_blocks_and_loses_nothing(spark, monkeypatch):
    rng = random.Random(5)
    base = text(rng, 80).split()
    rows = []
    for k in range(150):  # all nearly equal: they share their shards
        words = list(base)
        words[rng.randrange(80)] = f"unique{k}"
        rows.append((f"h{k:03}", " ".join(words)))
    want = brute(rows)
    monkeypatch.setattr(N, "BLOCK", 20)
    df = spark.createDataFrame(rows, "block_id string, content string").repartition(3)
    assert {(r.left, r.right) for r in N.similar_pairs(df).collect()} == want and len(want) > 10_000


def test_groups(spark):
    rows = corpus(random.Random(6)) + [("zz", None)]
    df = spark.createDataFrame(rows, "block_id string, content string")
    out = {r.key: r for r in N.groups(df).collect()}
    pairs = brute(rows)
    parent = {k: k for k, t in rows if t}

    def top(x):
        return x if parent[x] == x else top(parent[x])

    for a, b in pairs:
        parent[max(top(a), top(b))] = min(top(a), top(b))
    want = {}
    for k in parent:
        want.setdefault(top(k), set()).add(k)
    got = {}
    for k, r in out.items():
        got.setdefault(r.group_id, set()).add(k)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_empty(spark):
    df = spark.createDataFrame([], "block_id string, content string")
    assert N.similar_pairs(df).count() == 0 and N.groups(df).count() == 0
