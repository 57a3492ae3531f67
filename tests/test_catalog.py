"""Every query of the catalog against its SQL."""

import os

import pytest
from comparison import connect, differences

from itemflow.catalog import ORACLES, QUERIES

SF_DIR = os.environ.get("ITEMFLOW_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    # empty on both sides is right only where nothing is meant to be found
    difference = differences(QUERIES[name](spark, SF_DIR), con, ORACLES[name])
    assert difference is None, difference
