"""Every named query against its SQL twin on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from registry import QUERIES
from check import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    frame = queries()[name](spark, SF)
    if name in oracle_sql():
        assert compare(frame, db, oracle_sql()[name]) == ""
    else:
        assert frame.count() > 0


def test_entry_has_the_mart_columns(spark):
    from vacancia.schemas import MART_COLUMNS

    assert entry(spark).columns == MART_COLUMNS
    assert len(MART_COLUMNS) == 36
