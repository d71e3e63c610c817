"""Every registered query gives the rows of its SQL."""

import pytest

import __spark_entry__ as contract
from checks import compare, queries


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query_matches_sql(spark, sf_dir, name):
    assert compare.difference(spark, name, sf_dir) is None


def test_every_query_has_sql():
    assert set(queries.QUERIES) <= contract.oracle_sql().keys() <= contract.queries().keys()


def test_entry_gives_daily_figures(spark):
    frame = contract.entry(spark)
    assert frame.columns == [
        "payment_day",
        "currency",
        "event_count",
        "successful_count",
        "successful_amount",
    ]
    assert frame.count() > 0
