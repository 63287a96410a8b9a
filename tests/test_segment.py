from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inkwell.functions import segment as S


def test_dictionary_tokens(spark):
    df = spark.createDataFrame([("学校供餐方案Plan 2004，供水",), (None,), ("",)], "t string")
    f = S.dictionary_tokens(["学校", "供餐", "学校供餐", "方案"])
    assert [r[0] for r in df.select(f("t")).collect()] == [["学校供餐", "方案", "plan", "2004", "供", "水"], None, []]


@settings(max_examples=200, deadline=None)
@given(st.text("ab", max_size=24), st.text("ab", max_size=24), st.integers(1, 4))
def test_longest_common_equals_brute_force(a, b, least):
    want = max((a[i:j] for i in range(len(a)) for j in range(i + least, len(a) + 1) if a[i:j] in b), key=len, default="")
    assert len(S.longest_common(a, b, least)) == len(want) and S.longest_common(a, b, least) in b


@settings(max_examples=200, deadline=None)
@given(st.text("abc", max_size=18), st.lists(st.text("abc", min_size=1, max_size=3), min_size=1, max_size=3))
def test_shortest_window_equals_brute_force(text, pieces):
    all_in = [(j - i, i, j) for i in range(len(text) + 1) for j in range(i, len(text) + 1) if all(p in text[i:j] for p in pieces)]
    got = S.shortest_window(text, pieces)
    assert (got is None) == (not all_in) and (not all_in or got[1] - got[0] == min(all_in)[0])


def test_as_columns(spark):
    df = spark.createDataFrame([("the council reviewed the tariffs again", "then the council reviewed the tariffs"), (None, "x"), ("short", "short")], "a string, b string")
    assert [r[0] for r in df.select(S.common_stretch("a", "b")).collect()] == ["the council reviewed the tariffs", None, None]
    assert [r[0] for r in df.select(S.covering_window("a", F.array(F.lit("council"), F.lit("the")))).collect()] == [[0, 11], None, None]
