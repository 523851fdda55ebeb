"""Every query against its SQL on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry
from compare import compare, connect
from tidemark.plans.oracle import ORACLE
from tidemark.plans.queries import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, SF_DIR, QUERIES[name], ORACLE[name]) is None


def test_entry_runs(spark):
    assert entry(spark).columns[-1] == "volatility_rank"
