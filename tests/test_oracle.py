"""Every registered query against its SQL twin on the smallest tables."""

import re

import pytest
from conftest import SF, plan_of

import __spark_entry__ as contract
import oracle_tools

QUERIES, ORACLES = (
    {name: x for name, x in found().items() if name != "pipeline" and not re.match(r"op\d+_", name)}
    for found in (contract.queries, contract.oracle_sql)
)


@pytest.fixture(scope="module")
def duck():
    return oracle_tools.connect(SF)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert oracle_tools.compare(df, duck, ORACLES[name]) is None


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "county_fips" and df.columns[-1] == "year" and len(df.columns) == 29
    assert df.limit(1).count() == 1
