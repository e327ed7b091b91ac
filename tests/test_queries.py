"""Every registered query against its SQL on the smallest driver tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from catalog_sync.plans import registry
from check_oracles import compare, connect

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(registry.runs()) == set(registry.oracles())
    assert set(registry.runs()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(registry.runs()))
def test_query_equals_sql(spark, con, name):
    _, problems = compare(entry.queries()[name](spark, FOLDER), con, entry.oracle_sql()[name])
    assert problems == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
