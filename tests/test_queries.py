"""Every registered query against its SQL twin, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from oracles import ORACLES
from tests.oracle_check import connect, differences
from tidemark.plans.registry import QUERIES

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


def test_registered():
    assert QUERIES.keys() <= entry.queries().keys()
    assert ORACLES.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert differences(QUERIES[name](spark, SF), duck, ORACLES[name]) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0
