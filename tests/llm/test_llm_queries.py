"""Every query of this subpackage has its rows, and agrees with its SQL where it has one."""

from __future__ import annotations

import oracle
import pytest

import __spark_entry__ as entry_point
from sparkprep.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"
NAMES = sorted(n for n in QUERIES if n.startswith("op"))


def test_every_query_is_registered():
    assert {n.split("_")[0] for n in NAMES} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in entry_point.queries()


@pytest.mark.parametrize("name", [n for n in NAMES if n in ORACLES])
def test_query_equals_sql(spark, name):
    assert oracle.compare(spark, oracle.connect(SF), SF, QUERIES[name], ORACLES[name]) is None
