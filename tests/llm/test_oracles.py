"""Registered corpus queries against their SQL on a small table folder."""

import pytest

from dssforge.llm import entries

from .helpers import oracle, rows_of

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(entries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    assert rows_of(entries.queries()[name](spark, SF)) == oracle(entries.oracle_sql()[name], SF)


def test_every_operator_is_registered_once():
    numbers = sorted(int(k[2:].split("_")[0]) for k in entries.queries())
    assert numbers == list(range(1, 14))
