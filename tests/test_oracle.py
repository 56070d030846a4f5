"""Every registered query against its DuckDB oracle at sf0.01 (the driver's gate)."""

import os

import pytest

from tests.oracle_check import compare, duck_connection
from tidemark.plans.catalog import QUERIES
from tidemark.plans.oracle import ORACLE_SQL

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLE_SQL[name], SF)
    assert r["ok"], r


def test_production_build_matches_oracle(spark, con, scratch):
    """The written gold marts (built from silver Parquet) equal the oracle too."""
    from tidemark.plans.build import MARTS, materialize
    from tidemark.sources.sinks import Layout
    from tidemark.sources.testdata import raw_tables
    from tidemark.plans.catalog import THRESHOLD
    gold, checks = materialize(raw_tables(spark, SF), Layout(spark, scratch), THRESHOLD)
    for name in MARTS:
        r = compare(spark, con, name, lambda s, d, df=gold[name]: df, ORACLE_SQL[name], SF)
        assert r["ok"], r
