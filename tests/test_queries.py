"""Every registered query with an oracle matches DuckDB at sf0.001 (fast subset of the
driver's check); the flagship runs; plans import without a Spark session."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from assay.sources.tables import DRIVER_TABLES

SF = "/root/testdata/sf0.001"
FAST = list(E.oracle_sql())


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = []
    for r in rows:
        t = []
        for i in order:
            v = r[i]
            if isinstance(v, float) and math.isnan(v):
                v = "nan"
            t.append(v)
        out.append(tuple(t))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in DRIVER_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _norm(srows, df.columns) == _norm(cur.fetchall(), dcols)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "feature" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
