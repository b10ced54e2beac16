"""Every query with SQL against DuckDB on the smallest data, and every other core query for rows and schema."""

import glob
import math
import os

import pytest

import __spark_entry__ as entry

SF = os.environ.get("ASSAYFLOW_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


def _norm(v):
    if v is None or isinstance(v, (bool, str)):
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}"
    try:
        return f"{float(v):.6g}" if not isinstance(v, int) else str(v)
    except (TypeError, ValueError):
        return str(v)


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    c.execute("set timezone='UTC'")
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_as_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in columns) for r in df.collect()), key=str)
    rel = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == columns
    want = sorted((tuple(_norm(r[names.index(c)]) for c in columns) for r in rel.fetchall()), key=str)
    assert got == want


@pytest.mark.parametrize("name", sorted(n for m in entry._MODULES for n in m.QUERIES if n not in m.ORACLE))
def test_runs(spark, name):
    df = entry.queries()[name](spark, SF)
    rows = df.collect()
    assert len(set(df.columns)) == len(df.columns) and df.columns == [f.name for f in df.schema]
    again = entry.queries()[name](spark, SF)
    assert again.schema == df.schema and sorted(map(str, again.collect())) == sorted(map(str, rows))


def test_entry(spark):
    assert entry.entry(spark).count() > 0
