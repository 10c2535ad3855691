"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as registered
from checks.run import connect, difference
from checks.standins import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(registered.queries())


def test_entry(spark):
    assert registered.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, duck, name):
    actual = QUERIES[name](spark, SF_DIR).toPandas()
    expected = duck.execute(ORACLES[name]).df()
    assert len(expected) > 0
    assert difference(actual, expected) is None
