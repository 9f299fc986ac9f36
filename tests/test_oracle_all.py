"""Every query with a SQL twin against DuckDB at sf0.001 (about 6 minutes).
Opt-in: AUTOSCOPE_FULL_ORACLE=1 python -m pytest tests/test_oracle_all.py"""
import math
import os

import duckdb
import pytest

from conftest import SF_SMALL

import __spark_entry__ as E

pytestmark = pytest.mark.skipif(os.environ.get("AUTOSCOPE_FULL_ORACLE") != "1",
                                reason="set AUTOSCOPE_FULL_ORACLE=1 to run every oracle query")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "documents", "embeddings", "benchmark"]


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    def norm(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(round(v, 9))
        return v if v is None else str(v)
    return sorted(repr([norm(r[i]) for i in order]) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rel = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(ocols)
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(ocols, rel.fetchall())
