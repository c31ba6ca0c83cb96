"""Every query against its SQL in DuckDB, on the smallest tables."""

import datetime
import decimal
import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry

D = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{D}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (float, decimal.Decimal)):
        return None if v != v else round(float(v), 6)
    if isinstance(v, datetime.date) and not isinstance(v, datetime.datetime):
        return datetime.datetime(v.year, v.month, v.day)
    return v


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, duck, name):
    cursor = duck.execute(SQL[name])
    columns = [c[0] for c in cursor.description]
    want = cursor.fetchall()
    df = entry.queries()[name](spark, D)
    assert sorted(columns) == sorted(df.columns)
    order = sorted(columns)
    pick = lambda rows, names: sorted((tuple(plain(r[names.index(c)]) for c in order) for r in rows), key=str)
    assert pick(want, columns) == pick(df.collect(), df.columns)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "event_count" in df.columns


def test_core_imports_nothing_optional():
    core = {k for k in entry.queries() if not k.startswith("op") and k != "pipeline"}
    assert len(core) >= 120
    import subprocess
    import sys

    code = "import sys, annalist.plans.registry as r, annalist.pipeline; r.queries(); sys.exit(any(m.startswith('annalist.llm') for m in sys.modules))"
    assert subprocess.run([sys.executable, "-c", code], cwd=os.path.dirname(entry.__file__)).returncode == 0
