import pytest

import __spark_entry__ as entry
import check

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check.database(SF)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    ok, note = check.compare(spark, con, SF, name)
    assert ok, note


def test_entry(spark):
    assert entry.entry(spark).count() > 0
