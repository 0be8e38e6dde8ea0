"""Every registered query against its DuckDB SQL on the smallest test tables."""

import datetime as dt
import math

import duckdb
import pytest

from ledgerlens.plans.oracle import ORACLE_SQL
from ledgerlens.plans.registry import QUERIES
from ledgerlens.sources.tables import DRIVER_TABLES

SF = "/root/testdata/sf0.001"


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return float(f"{v:.12g}")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in DRIVER_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF)
    con.execute(f"CREATE OR REPLACE VIEW checked AS {ORACLE_SQL[name]}")  # the SQL stands in a view, too
    rel = con.sql("SELECT * FROM checked")
    assert sorted(sdf.columns) == sorted(rel.columns)
    order = sorted(sdf.columns)
    si = [sdf.columns.index(c) for c in order]
    oi = [rel.columns.index(c) for c in order]
    s = _sorted([tuple(_norm(r[i]) for i in si) for r in sdf.collect()])
    o = _sorted([tuple(_norm(r[i]) for i in oi) for r in rel.fetchall()])
    assert len(s) == len(o)
    assert s == o
