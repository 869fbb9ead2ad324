"""Every registered query against its SQL on whole tables, and the entry point."""

import compare
import pytest

import __spark_entry__ as entry_point

SF = "0.001"
QUERIES = entry_point.queries()
ORACLES = entry_point.oracle_sql()

pytestmark = pytest.mark.skipif(not compare.has_data(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return compare.connect(compare.data_dir(SF))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    rows = QUERIES[name](spark, compare.data_dir(SF))
    assert compare.differences(rows, con, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, compare.data_dir(SF)).count() > 0


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
