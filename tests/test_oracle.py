"""Every driver query against its DuckDB oracle (sf0.001 keeps this quick;
the driver's own gate runs sf0.01)."""

import os

import pytest

import __spark_entry__ as se
from tests.oracle_util import compare, duck

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
NAMES = sorted(se.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    missing = set(se.QUERIES) - set(se.oracle_sql())
    assert not missing, missing


def test_entry_runs(spark):
    df = se.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["symbol", "time"]


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(se.queries()[name](spark, SF), con, se.oracle_sql()[name])
    assert ok, msg
