"""Every query with SQL, against DuckDB on the smallest test set."""

import os

import pytest

import __spark_entry__ as entry
import check

SF = "/root/testdata/sf0.001"
CHECKED = sorted(entry.oracle_sql())

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not here")


@pytest.fixture(scope="module")
def duck():
    return check.connect(SF)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, duck, name):
    result = check.compare(name, entry.queries()[name](spark, SF), entry.oracle_sql()[name], duck)
    assert result.startswith("ok") and "TYPES" not in result, result


def test_entry(spark, monkeypatch):
    assert entry.entry(spark).count() > 0


def test_all_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
