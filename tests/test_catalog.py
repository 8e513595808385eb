"""Every registered query against its SQL on the smallest tables, and the driver contract."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from rillstone.plans import CHECKS, QUERIES
from tests.check_queries import compare, duck

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    flagship = contract.entry(spark)
    assert set(flagship.columns) == {
        "window_start", "window_end", "category", "event_type", "item", "hits", "rank_no",
    }
    assert flagship.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert name in CHECKS, "each query so far has a SQL form"
    assert compare(spark, con, FOLDER, name, QUERIES[name], CHECKS[name]) == ""
