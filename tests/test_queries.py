"""Every registered query with an oracle: Spark result == DuckDB result on
the small tables (row count, column names, values after rounding)."""

import math
import os

import pytest

from .conftest import SF_SMALL

duckdb = pytest.importorskip("duckdb")

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from tabforge.sources.tables import TABLES  # noqa: E402


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NULL" if math.isnan(v) else repr(round(v, 6) + 0.0)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test tables not present")
@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    sdf = queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(ocols)
    assert _rows(sdf.columns, srows) == _rows(ocols, orows)


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test tables not present")
def test_entry_runs(spark):
    df = entry(spark)
    rows = df.collect()
    assert len(rows) >= 5 and df.columns == ["bin", "band", "lo", "hi", "total", "positives", "risk_rate"]
