"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

from fareweave.plans.registry import ORACLES, QUERIES, load_all
from tools.oracle_check import compare, duck_conn

from .conftest import SF_SMALL

load_all()
KEYS = sorted(ORACLES)


@pytest.fixture(scope="module")
def con():
    return duck_conn(SF_SMALL)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, key, QUERIES[key], ORACLES[key], SF_SMALL, con)
    assert r["status"] in ("EXACT", "TOL12"), r
    assert "types" not in r, r


def test_every_key_has_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_queries_run(spark, key):
    df = QUERIES[key](spark, SF_SMALL)
    rows = df.collect()
    assert len(rows) >= 1
    assert len(df.columns) == len(set(df.columns))
