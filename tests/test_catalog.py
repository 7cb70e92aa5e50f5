"""Every registered query against its SQL on the smallest tables."""

import pytest

from entitylake.plans.catalog import CHECKS, QUERIES
from tests.compare import connect, difference


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, sf, name):
    df = QUERIES[name](spark, sf)
    if name not in CHECKS:
        assert df.count() > 0
        return
    problem = difference(df, con, CHECKS[name])
    assert problem is None, problem


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
