"""Every registered query against the SQL that defines it."""

import pytest

import __spark_entry__ as entry
import oracle
from stratalake import catalogue

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = catalogue.load()


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, duck, name):
    assert oracle.differences(QUERIES[name](spark, SF_DIR), duck, SQL[name]) == []


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "change_pct" in df.columns
