"""Steps on small tables."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from larderline.operators import conform, inspection, loading, nulls
from larderline.schemas import ORDERS, text_only

NAN = float("nan")


def test_drop_equals_dropna(spark):
    df = spark.createDataFrame(
        [(1, 1.0, "a"), (2, NAN, "b"), (3, None, "c"), (None, 4.0, "d"), (5, 5.0, None)],
        "i int, d double, s string",
    )
    assert nulls.drop_null_rows(df).collect() == df.dropna().collect()


def test_null_rows_leave_nan_alone(spark):
    df = spark.createDataFrame([(1, NAN), (2, None)], "i int, d double")
    assert [row.i for row in nulls.null_rows(df).collect()] == [2]


def test_policies(spark):
    df = spark.createDataFrame(
        [(1, None, Decimal("2.00"), "ok"), (None, 1, Decimal("2.00"), "ok")],
        "order_id long, quantity int, price decimal(10,2), status string",
    )
    assert nulls.apply_null_policy(df, "drop", nulls.ORDER_DEFAULTS).count() == 0
    filled = nulls.apply_null_policy(df, "fill", nulls.ORDER_DEFAULTS).collect()
    assert [(row.order_id, row.quantity) for row in filled] == [(1, 0)]
    with pytest.raises(ValueError, match="null policy"):
        nulls.apply_null_policy(df, "keep", nulls.ORDER_DEFAULTS)


def test_defaults_match_names_in_any_case(spark):
    df = spark.createDataFrame(
        [("tools", None, None)], "category string, Warehouse string, stock_level string"
    )
    filled = nulls.fill_defaults(df, nulls.INVENTORY_DEFAULTS)
    assert tuple(filled.first()) == ("tools", "unknown", "0")


def test_standardize_renames_to_the_given_spelling(spark):
    df = spark.createDataFrame([(" East ",)], "Warehouse string")
    result = conform.standardize(df, "warehouse")
    assert (result.columns, result.first()[0]) == (["warehouse"], "east")


def test_malformed_inventory_text_becomes_null(spark):
    df = spark.createDataFrame(
        [("7", "n/a", "2025-07-01 08:00:00"), ("x", "12", "never")],
        "item_id string, stock_level string, last_update string",
    )
    rows = [tuple(row) for row in conform.cast_inventory(df).collect()]
    assert rows == [(7, None, dt.datetime(2025, 7, 1, 8)), (None, 12, None)]


def test_unknown_status_goes_with_the_test_orders(spark):
    df = spark.createDataFrame([("test",), ("pending",), (None,)], "status string")
    assert [row.status for row in conform.drop_test_orders(df).collect()] == ["pending"]


def test_distinct_is_idempotent(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "i int, s string")
    once = conform.distinct_rows(df)
    assert once.count() == conform.distinct_rows(once).count() == 2


GOOD = ("1", "2", "3", "4", "5.25", "2025-07-01T08:00:00Z", "pending")
BAD = ("2", "2", "3.5", "many", "5.25", "2025-07-01T08:00:00Z", None)


def orders_text(spark, *rows):
    return spark.createDataFrame(rows, text_only(ORDERS))


def test_orders_are_accepted_or_rejected(spark):
    rows = orders_text(spark, GOOD, BAD)
    accepted = loading.accepted_orders(rows)
    assert accepted.schema.simpleString() == ORDERS.simpleString()
    assert [row.order_id for row in accepted.collect()] == [1]
    rejected = loading.rejected_orders(rows).first()
    assert (rejected.order_id, rejected.bad_fields) == ("2", "item_id,quantity")


def test_empty_status_is_valid_text(spark):
    row = loading.accepted_orders(orders_text(spark, (*GOOD[:-1], None))).first()
    assert row.status == ""


def test_strict_load_fails_on_the_first_bad_row(spark):
    assert loading.all_orders_or_fail(orders_text(spark, GOOD)).count() == 1
    with pytest.raises(SparkRuntimeException, match="order row with bad item_id,quantity"):
        loading.all_orders_or_fail(orders_text(spark, GOOD, BAD)).count()


def test_key_conflicts(spark):
    incoming = spark.createDataFrame([(1,), (2,), (2,), (3,)], "order_id long")
    loaded = spark.createDataFrame([(1,), (1,), (9,)], "order_id long")
    conflicts = {tuple(r) for r in loading.key_conflicts(incoming, loaded, "order_id").collect()}
    assert conflicts == {(1, 1, "loaded before"), (2, 2, "repeated")}
    new = loading.new_rows(incoming, loaded, "order_id").collect()
    assert sorted(row.order_id for row in new) == [2, 2, 3]


def test_nested_columns_are_found(spark):
    df = spark.range(1).select("id", F.array("id").alias("many"), F.struct("id").alias("deep"))
    assert inspection.nested_columns(df.schema) == ["many", "deep"]
    with pytest.raises(ValueError, match="many"):
        inspection.require_flat(df)
