"""Every registered query against its SQL oracle on the small tables."""

import pytest

import __spark_entry__ as entry
from tests import compare

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return compare.duck(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf, con):
    problem, _, _, _ = compare.difference(spark, con, sf, QUERIES[name], ORACLES.get(name))
    assert problem is None


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["neighborhood_name", "hazard_type", "event_count", "avg_severity"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
