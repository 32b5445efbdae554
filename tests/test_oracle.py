"""Every registered query with SQL must agree with DuckDB on whole tables."""

import pytest

from compare import duck, duck_rows, spark_rows
from ledgerlens.plans import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, con, name):
    columns, rows = spark_rows(QUERIES[name](spark, SF_DIR))
    expected_columns, expected = duck_rows(con, ORACLE[name])
    assert columns == expected_columns
    assert rows == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs_without_sql(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0
