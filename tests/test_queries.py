"""Registered queries beside their DuckDB statements on the smallest tables."""

import os

import pytest

import __spark_entry__ as E
from checks.compare import connect, differences
from checks.oracles import ORACLES
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(E.queries())


@needs_data
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_statement(spark, con, name):
    assert differences(name, spark, con, SF_DIR) == []


@needs_data
def test_entry(spark):
    assert E.entry(spark).columns == ["item_no", "akn_uri", "target_folder"]
