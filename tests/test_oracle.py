"""Every query with SQL gives the rows of that SQL, on the smallest tables."""

from __future__ import annotations

import oracle
import pytest

import workload

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", list(workload.QUERIES))
def test_query(spark, con, name):
    ok, note = oracle.compare(spark, con, name, SF)
    assert ok, note


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
