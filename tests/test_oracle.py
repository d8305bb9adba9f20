"""Every registered query against its DuckDB oracle on sf0.001 (driver contract)."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as E
from marketlake.plans import catalog, catalog_tables, oracle_tables
from marketlake.plans import oracle_sql as oracles

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
SLOW = {"stream_equity_clean", "stream_fo_clean"}


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _key(row):
    return tuple((x is None, str(x)) for x in row)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def test_every_query_has_an_oracle():
    assert set(oracles.build_all()) == set(catalog.QUERIES) and set(oracle_tables.build()) == set(catalog_tables.QUERIES)
    assert set(catalog.QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "pcr_oi" in df.columns and "ad_ratio" in df.columns


@pytest.mark.parametrize("name", sorted(oracles.build_all() | oracle_tables.build()))
def test_query_matches_oracle(spark, sf_dir, duck, name):
    sdf = E.queries()[name](spark, sf_dir)
    cols = sdf.columns
    srows = sorted((tuple(_norm(v) for v in r) for r in sdf.collect()), key=_key)
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(ocols)
    perm = [ocols.index(c) for c in cols]
    orows = sorted((tuple(_norm(r[i]) for i in perm) for r in res.fetchall()), key=_key)
    assert len(srows) == len(orows)
    assert srows == orows
