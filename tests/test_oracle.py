"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from lakeloom.plans.standins import TABLES

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
SQL = E.oracle_sql()
QUERIES = E.queries()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i].lower())
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and len(df.columns) > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name not in SQL:
        assert len(df.columns) > 0
        return
    cur = con.execute(SQL[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(c.lower() for c in df.columns) == sorted(c.lower() for c in ocols)
    from tools.check_oracle import spark_type_name
    stypes = {f.name.lower(): spark_type_name(f.dataType) for f in df.schema.fields}
    otypes = {d[0].lower(): str(d[1]) for d in cur.description}
    assert stypes == otypes
    assert _canon(rows, df.columns) == _canon(cur.fetchall(), ocols)
