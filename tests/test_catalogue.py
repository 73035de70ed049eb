"""Every query of the catalogue next to its SQL twin, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from check import compare, connect
from vacantia.catalogue import registry

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = registry.QUERIES, registry.ORACLES

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    rows, _, verdict = compare(spark, con, SF_DIR, name, QUERIES[name], ORACLES[name])
    assert verdict.startswith("ok") and "TYPES" not in verdict, verdict


def test_entry(spark):
    assert entry.entry(spark).count() > 0
