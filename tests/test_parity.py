"""Every registered query against its SQL, on whole test tables."""

import pytest

import __spark_entry__ as entry
from parity.registry import ORACLES, QUERIES
from parity.check import compare, database


@pytest.fixture(scope="module")
def db(sf_dir):
    return database(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_agrees(spark, sf_dir, db, name):
    assert compare(QUERIES[name](spark, sf_dir), db.sql(ORACLES[name])) == ""


def test_entry_has_the_fact_columns(spark):
    from orderloom.plans.item_fact import FACT_COLUMNS

    assert entry.entry(spark).columns == FACT_COLUMNS
    assert len(FACT_COLUMNS) == 94
