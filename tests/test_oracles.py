"""Every registered query against its SQL equivalent, on the smallest driver tables."""

import os

import oracle
import pytest

import __spark_entry__ as entry
from marginalia.plans import catalog, oracles

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


def test_every_query_of_the_catalogue_has_sql():
    assert set(catalog.registered()) == set(oracles.sql())
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", list(catalog.registered()))
def test_query_matches_sql(spark, con, name):
    assert oracle.compare(spark, con, QUERIES[name], SQL[name], SF_DIR) is None


def test_flagship_runs(spark):
    rows = entry.entry(spark).collect()
    assert {r["auto_label"] for r in rows} == {"en", "fr", "de", "es"}
