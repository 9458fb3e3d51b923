"""Every registered query against its reference SQL, and the shape of its plan."""

import re

import pytest
from conftest import planned
from oracle import compare, connect

from tidemark.catalog import QUERIES, REFERENCE_SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    plan = planned(df)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert not re.search(r"Python|Pandas|Arrow", plan)
    difference = compare(con, df, REFERENCE_SQL[name])
    assert difference is None, difference


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert set(QUERIES) <= set(contract.queries())
    assert set(REFERENCE_SQL) <= set(contract.oracle_sql()) <= set(contract.queries())
