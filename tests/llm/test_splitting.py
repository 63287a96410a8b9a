from hypothesis import given, settings
from hypothesis import strategies as st

from inkwell.llm import splitting as P


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab .\n。，#𠮷", max_size=400), st.integers(1, 80), st.integers(0, 90))
def test_pieces_cover_fit_and_overlap(text, limit, overlap):
    cuts = P.cuts(text, limit, overlap)
    assert cuts[0][0] == 0 and cuts[-1][1] == len(text)
    assert all(b - a <= limit for a, b in cuts)
    shared = min(overlap, limit - 1)
    assert all(e - s2 == shared for (_, e), (s2, _) in zip(cuts, cuts[1:]))
    rebuilt = text[: cuts[0][1]] + "".join(text[a + shared : b] for a, b in cuts[1:])
    assert rebuilt == text


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 120), st.sampled_from([" ", ". ", "\n", "\n\n", "。", "，"])), max_size=12), st.integers(2, 90), st.integers(0, 90))
def test_no_hard_cut_where_a_boundary_lies(parts, limit, overlap):
    text = "".join("x" * n + end for n, end in parts)
    shared = min(overlap, limit - 1)
    natural = {int(b) for rank in P.boundaries(text) for b in rank}
    for start, end in P.cuts(text, limit, overlap)[:-1]:
        assert end in natural or end == start + limit and not any(start + shared < b <= end for b in natural)


def test_an_early_boundary_comes_before_a_hard_cut():
    text = "a" * 28 + "\n\n" + "b" * 300
    assert P.cuts(text, 100, 10)[0] == (0, 30)
    assert P.cuts("a" * 10 + " " + "b" * 18 + ". " + "c" * 300, 100, 10)[0] == (0, 31)
    assert P.cuts(text, 100, 30)[0] == (0, 100)  # no progress beyond the overlap


def test_natural_boundaries_come_first():
    text = "One sentence here. " * 4 + "\n\n" + "Another one follows. " * 4
    (a, b), *_ = P.cuts(text, 100, 10)
    assert text[:b].endswith("\n\n")
    (a, b), *_ = P.cuts("word " * 40, 52, 5)
    assert b % 5 == 0
    assert P.cuts("x" * 250, 100, 20) == [(0, 100), (80, 180), (160, 250)]


def test_tables(spark):
    rows = [("a", ["h"], "s. " * 60), ("a", ["h"], "s. " * 60), ("b", None, "short"), ("n", None, None), ("e", [], ""), ("u", None, "𠮷" * 101)]
    items = spark.createDataFrame([(*r, 5, "p") for r in rows], "segment_id string, heading_path array<string>, content string, char_count int, profile string")
    limits = spark.createDataFrame([("standard", 100, 20), ("compact", 50, None), (None, 3, 1), ("none", None, 4)], "profile string, max_chars int, overlap_chars int")
    got = P.split_items(items, limits).collect()
    assert {(r.segment_id, r.profile) for r in got} == {("a", "standard"), ("a", "compact"), ("u", "standard"), ("u", "compact")}
    assert len({(r.segment_id, r.profile, r.piece_no) for r in got}) == len(got)
    assert all(len(r.content) <= (100 if r.profile == "standard" else 50) for r in got)
    assert all(r.heading_path == ["h"] for r in got if r.segment_id == "a")
    assert {r.segment_id for r in P.found(items, limits).collect()} == {"a", "u"}
    assert P.found(items.limit(0), limits).count() == 0 and P.split_items(items, limits.limit(0)).count() == 0
