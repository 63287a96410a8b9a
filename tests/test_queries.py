"""Every query with SQL equals it on the smallest tables."""

import glob
import math

import pytest

from inkwell import catalogue

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in glob.glob(D + "/*.parquet"):
        con.execute(f"create view {f.rsplit('/', 1)[1][:-8]} as select * from read_parquet('{f}')")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "NULL"
    return f"{v:.6g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = catalogue.queries()[name](spark, D)
    cols = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    cur = duck.execute(catalogue.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == cols
    want = sorted(tuple(plain(r[names.index(c)]) for c in cols) for r in cur.fetchall())
    assert got == want


def test_all_queries_are_plans(spark):
    for name, f in catalogue.queries().items():
        assert callable(f), name


def test_the_library_stands_without_the_llm_subpackage():
    import subprocess
    import sys

    code = "import sys; sys.modules['inkwell.llm'] = None; import __spark_entry__ as e; assert e.llm is None and not [q for q in e.queries() if q.startswith('p')]; import inkwell.sources.files, inkwell.streaming.telemetry"
    assert subprocess.run([sys.executable, "-c", code], capture_output=True).returncode == 0
