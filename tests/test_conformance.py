"""Every registered query against its oracle on the smallest tables."""

import pytest

import __spark_entry__ as entry
from conformance.compare import compare, duck

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, sf, name):
    text, _, ok = compare(spark, con, name, QUERIES[name], ORACLES.get(name), sf)
    assert ok, text


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
