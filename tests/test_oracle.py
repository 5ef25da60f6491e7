"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from boreflow.plans.registry import QUERIES as REGISTERED
from boreflow.plans.standin import TABLES
from tests.conftest import SF_SMALL, nsort

# the training-data queries have tests of their own in tests/llm
QUERIES = {k: v for k, v in entry.queries().items() if k in REGISTERED}
ORACLE = {k: v for k, v in entry.oracle_sql().items() if k in REGISTERED}


def canon(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "monthly_oil_vol" in df.columns


def test_every_query_has_oracle_or_is_listed():
    no_oracle = set(QUERIES) - set(ORACLE)
    assert no_oracle <= {"dq_quartiles", "payload_shape"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    cols = sorted(sdf.columns)
    srows = nsort(tuple(canon(r[c]) for c in cols) for r in sdf.collect())
    if name not in ORACLE:
        assert sdf.schema is not None
        return
    cur = duck.execute(ORACLE[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == cols
    drows = nsort(tuple(canon(dict(zip(dcols, r))[c]) for c in cols) for r in cur.fetchall())
    assert len(srows) == len(drows)
    assert srows == drows
