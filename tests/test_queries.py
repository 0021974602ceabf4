"""Every registered query that has an SQL counterpart gives its rows at the smallest scale."""

import pytest

import __spark_entry__ as e
from pyrogrid.plans import catalog

from tests.compare import frames, same

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_same_as_sql(spark, name):
    assert not same(*frames(spark, SF, name, catalog.QUERIES[name], catalog.ORACLE_SQL[name]))


def test_entry(spark):
    assert e.entry(spark).count() == 4


def test_without_sql(spark):
    for name in set(catalog.QUERIES) - set(catalog.ORACLE_SQL):
        assert catalog.QUERIES[name](spark, SF).count() > 0, name
