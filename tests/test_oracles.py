"""Every registered query equals its SQL on the smallest tables."""

import pytest
from conftest import SMALL

import check
from __spark_entry__ import entry, oracle_sql, queries
from guestbook.plans.registry import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, database, name):
    assert check.difference(spark, database, SMALL, name) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.columns[0] == "Hotel_Name"
    assert df.count() == 10


def test_every_lineitem_is_one_review(spark):
    from guestbook.plans.relations import STAR_COLUMNS, reviews, table

    assert reviews(spark, SMALL, *STAR_COLUMNS).count() == table(spark, SMALL, "lineitem").count()


def test_tie_breaks_are_unique(spark):
    from guestbook.plans.relations import STAR, reviews

    df = reviews(spark, SMALL, "Hotel_Name", "Review_Date", *STAR.key)
    assert df.distinct().count() == df.count()
