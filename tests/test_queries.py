"""Every registered query against its SQL on the small tables."""

from __future__ import annotations

import pytest
from oracle import compare, connect

import __spark_entry__ as entry_point
from tideline.plans import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    ok, note = compare(spark, con, name, SF_DIR)
    assert ok, note


def test_contract(spark):
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
    assert entry_point.entry(spark).count() > 0
