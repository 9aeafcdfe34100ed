"""Every registered query against its SQL on the test tables."""

from __future__ import annotations

import duckdb
import pytest

from larder_checks.queries import QUERIES
from larder_checks.sql import PARTS, STATEMENTS, oracle_statements

# No order is asked for, so which rows come is not determined.
ROWS_ONLY = {"orders_sample"}


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def _checked(tables, statement):
    connection = duckdb.connect()
    for name in ("lineitem", "orders", "part", "events"):
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tables}/{name}.parquet')"
        )
    result = connection.execute(statement)
    return [column[0] for column in result.description], result.fetchall()


def test_every_query_has_sql():
    assert set(QUERIES) - set(STATEMENTS) == ROWS_ONLY
    assert set(STATEMENTS) <= set(QUERIES)
    assert not set(PARTS) & {"lineitem", "orders", "part", "events"}


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_matches_sql(spark, tables, name):
    actual = QUERIES[name](spark, tables)
    columns, expected = _checked(tables, oracle_statements()[name])
    rows = [tuple(row) for row in actual.collect()]
    assert sorted(actual.columns) == sorted(columns)
    assert len(rows) == len(expected) > 0
    assert _sorted_rows(actual.columns, rows) == _sorted_rows(columns, expected)


def test_sample_takes_rows_of_the_table(spark, tables):
    sample = QUERIES["orders_sample"](spark, tables)
    assert sample.count() == 10
