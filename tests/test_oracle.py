"""Every registered query with SQL, against DuckDB on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, database

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables absent")

#: No holiday has five rows of the baseline in the smallest tables.
MAY_BE_EMPTY = {"holiday_day_table"}
#: Fits boosters with the library's settings, which takes minutes at any size: ``tests/oracle.py`` runs it.
SLOW = {"forecasts_of_all_learners"}


@pytest.fixture(scope="module")
def db():
    return database(FOLDER)


def test_keys_and_entry(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["key", "mae", "rmse", "r2", "n"]


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - SLOW))
def test_query(spark, db, name):
    found = compare(spark, db, entry.queries()[name], entry.oracle_sql()[name], FOLDER, empty_ok=name in MAY_BE_EMPTY)
    assert found is None
