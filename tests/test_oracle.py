"""Every named query against its SQL twin."""

import pytest

import __spark_entry__ as entry
from shelfpair.catalog.registry import ORACLES, QUERIES
from tests.conftest import SMALL
from tests.oracle import compare


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, name):
    ok, note = compare(spark, duck, name, entry.queries()[name], entry.oracle_sql()[name], SMALL)
    assert ok, note


def test_entry(spark):
    assert entry.entry(spark).count() == 79
