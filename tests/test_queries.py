"""Every registered query against its SQL, over whole tables."""

import pytest

from compare import connect, difference
from conftest import SMALL
from rowmill.queries import registry


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(registry()))
def test_query_matches_sql(spark, con, name):
    assert difference(spark, con, SMALL, name) is None


def test_entry(spark):
    import __spark_entry__ as entry
    assert entry.entry(spark).columns == ["ID", "NAME", "DEPT", "SAL", "AGE", "SAL_RANGE",
                                          "DATE_TIMESTAMP"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
