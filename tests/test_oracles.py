"""Every registered query against its SQL on the smallest tables."""

import os

import pytest
from oracle_check import compare, connect

from warcloom.plans import catalogue

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("key", sorted(catalogue.ORACLES))
def test_query_equals_sql(spark, duck, key):
    assert compare(spark, duck, SF, catalogue.QUERIES[key], catalogue.ORACLES[key]) is None


@pytest.mark.parametrize("key", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_rows_only_query_runs(spark, key):
    assert catalogue.QUERIES[key](spark, SF).count() > 0


def test_registry_is_consistent():
    assert set(catalogue.ORACLES) <= set(catalogue.QUERIES)
