"""Every registered query against its DuckDB oracle on the smallest scale."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from contentflow.plans.registry import REGISTRY

from table_dirs import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "as_tuple"):
        return round(float(v), 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["period", "job_name"]


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) & set(REGISTRY)))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = sorted([tuple(_norm(r[c]) for c in cols) for r in df.collect()], key=_key)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    exp = sorted([tuple(_norm(r[i]) for i in idx) for r in res.fetchall()], key=_key)
    assert got == exp


def test_every_query_has_oracle():
    assert set(REGISTRY) <= set(E.oracle_sql()) <= set(E.queries())
