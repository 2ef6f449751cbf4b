"""Every registered query against its SQL, on the smallest tables."""

import os

import parity
import pytest

import __spark_entry__ as contract
from tarnlake.plans.queries import QUERIES

FOLDER = os.environ.get("PARITY_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, name):
    df = contract.queries()[name](spark, FOLDER)
    assert parity.difference(df, FOLDER, contract.oracle_sql()[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).columns == ["CustomerID", "LastName", "FirstName", "OrderMonth", "ProductCount"]
