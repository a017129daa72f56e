"""Every query with SQL agrees with it on the smallest tables; the catalog is well formed."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
# those of the optional subpackage are checked in its own tests
CORE = sorted(n for n in entry.oracle_sql() if not entry.queries()[n].__module__.startswith("inkframe.llm"))


def norm(v):
    if v is None:
        return "~"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(norm, v)) + "]"
    if isinstance(v, dict):
        return norm(list(v.values()))
    return f"{float(v):.9g}" if isinstance(v, float) else str(int(v)) if isinstance(v, bool) else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return con


@needs_data
@pytest.mark.parametrize("name", CORE)
def test_agrees_with_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(norm(r[c]) for c in cols) for r in df.collect())
    rows = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in rows.description]
    assert sorted(names) == cols
    assert got == sorted(tuple(norm(r[names.index(c)]) for c in cols) for r in rows.fetchall())


@needs_data
def test_entry_runs(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
