"""Every registered query runs, and agrees with its SQL."""

from __future__ import annotations

import oracle
import pytest

import __spark_entry__ as entry_point

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["subset", "num_tokens", "num_samples"]
    assert df.count() == 9


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert oracle.compare(spark, con, SF, QUERIES[name], ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
