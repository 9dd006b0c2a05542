"""Every named query against its SQL statement, whole results compared."""

import os

import pytest

import __spark_entry__ as entry
from feedsieve.operators.load import typed_feed
from feedsieve.plans import oracles, queries, tables

from .compare import connect, difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = queries.queries(), oracles.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    """And no query, built once here, has Python or a cross join in its plan."""
    found = QUERIES[name](spark, SF_DIR)
    plan = found._jdf.queryExecution().executedPlan().toString()
    for banned in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "Pandas"):
        assert banned not in plan, banned
    assert difference(found, duck, ORACLES[name]) is None


def test_entry_runs(spark):
    rows = entry.entry(spark).collect()
    assert rows and rows[0].asDict().keys() == {"reason", "n"}


def test_typed_table_equals_the_typed_text_feed(spark):
    direct = tables.landed(spark, SF_DIR)
    through_text = typed_feed(tables.feed(spark, SF_DIR), tables.NTZ)
    assert direct.schema.simpleString() == through_text.schema.simpleString()
    assert direct.exceptAll(through_text).count() == 0
    assert through_text.exceptAll(direct).count() == 0
