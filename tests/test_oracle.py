"""Every registered query against its SQL on the smallest tables."""

import pytest
from oracle_check import compare, sql_connection

from linewright.plans import catalog

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return sql_connection(FOLDER)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, FOLDER, name, catalog.QUERIES[name], catalog.ORACLES.get(name)) is None


def test_every_oracle_has_a_query():
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)
