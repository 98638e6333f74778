"""Every registered query against its DuckDB oracle at sf0.001 (row count,
column names, order-insensitive values), and the driver entry points."""

import math

import duckdb
import pytest

from histevents.plans import registry as E
from histevents.sources.fixtures import BASE_TABLES
from tests.conftest import SF_SMALL

ORACLES = E.oracle_sql()
NO_ORACLE: set = set()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_registry_contract():
    q = E.queries()
    assert len(q) >= 50
    assert set(ORACLES) <= set(q)
    assert set(q) - set(ORACLES) == NO_ORACLE


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLES[name])
    drows = cur.fetchall()
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, srows) == _rows(dcols, drows)
    # same column types on both sides
    spark_types = {c: _TYPES.get(t, t) for c, t in df.dtypes}
    rel = duck.sql(ORACLES[name])
    duck_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert spark_types == duck_types


_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0].status in ("pass", "fail")
