"""Every registered operator against its DuckDB oracle (sf0.001)."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from dssforge.registry import oracle_statements, registered_queries
from helpers import duck, rows_of

QUERIES = registered_queries()
ORACLES = oracle_statements()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, name):
    got = rows_of(QUERIES[name](spark, SF_SMALL))
    want = duck(SF_SMALL, ORACLES[name])
    assert got[1] == want[1]
    assert len(got[0]) == len(want[0])
    assert got[0] == want[0]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["n_name", "revenue"]
    assert df.count() >= 0


MID = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(k for k in QUERIES if k[1:3].isdigit()))
def test_query_matches_oracle_at_sf001(spark, name):
    got = rows_of(QUERIES[name](spark, MID))
    want = duck(MID, ORACLES[name])
    assert got == want
