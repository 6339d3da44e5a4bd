"""Every registered query against its SQL on the star schema."""

import compare
import oracle
import pytest
import registry

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.star_database(DATA)


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(oracle.EXPECTED)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query(spark, con, name):
    df = registry.run(name, spark, DATA)
    assert compare.assert_same(df, con, oracle.expected_sql()[name]) > 0
