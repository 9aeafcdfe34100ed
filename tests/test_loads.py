"""Loads of orders that come whole or not at all, and what jobs count."""

from __future__ import annotations

import datetime as dt
import pathlib
import random
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from larderline.operators import loading, nulls
from larderline.plans import dims, jobs, kpis
from larderline.plans.warehouse import Warehouse
from larderline.schemas import ORDERS
from larder_checks import inputs


@pytest.fixture
def warehouse(spark, tmp_path):
    made = Warehouse(spark, f"loads_{uuid.uuid4().hex[:8]}", str(tmp_path / "root")).create()
    yield made
    made.drop()


def some_orders(spark, keys):
    moment = dt.datetime(2025, 7, 1, 8)
    return spark.createDataFrame([(k, 1, 2, 3, Decimal("4.00"), moment, "new") for k in keys], ORDERS)


def keys_of(warehouse):
    return sorted(row.order_id for row in warehouse.table("orders").collect())


def loads_of(warehouse):
    return pathlib.Path(warehouse.root) / "orders" / "loads"


def test_a_lost_load_is_not_seen(spark, warehouse):
    warehouse.append("orders", some_orders(spark, [1, 2]))
    whole = next(loads_of(warehouse).iterdir())
    # A job that ended between its files leaves some, but not the mark of all.
    lost = loads_of(warehouse) / "load_id=lost"
    lost.mkdir()
    for file in whole.glob("part-*"):
        (lost / file.name).write_bytes(file.read_bytes())
    assert keys_of(warehouse) == [1, 2]
    again = Warehouse(spark, f"again_{uuid.uuid4().hex[:8]}", warehouse.root).create()
    assert keys_of(again) == [1, 2]


def test_a_load_that_was_written_but_not_added_is_found(spark, warehouse):
    warehouse.append("orders", some_orders(spark, [1]))
    folder = loads_of(warehouse) / "load_id=written"
    some_orders(spark, [5, 6]).write.parquet(str(folder))
    assert keys_of(warehouse) == [1]
    assert keys_of(warehouse.create()) == [1, 5, 6]
    assert keys_of(warehouse.create()) == [1, 5, 6]


def test_a_failed_load_leaves_nothing(spark, warehouse):
    warehouse.append("orders", some_orders(spark, [1]))
    bad = F.assert_true(F.col("order_id") < 90, F.lit("broken")).isNull()
    rows = some_orders(spark, range(50, 99)).repartition(6).filter(bad)
    with pytest.raises(Exception, match="broken"):
        warehouse.append("orders", rows)
    assert keys_of(warehouse) == [1]
    assert keys_of(warehouse.create()) == [1]


def test_sql_reads_the_loads(spark, warehouse):
    for keys in ([1, 2], [3]):
        warehouse.append("orders", some_orders(spark, keys))
    assert warehouse.table("orders").schema == ORDERS
    assert spark.sql(f"SELECT max(order_id) FROM {warehouse.name('orders')}").first()[0] == 3


@pytest.mark.parametrize("listed", [0, 1000])
def test_near_keys_lose_no_conflict(spark, monkeypatch, listed):
    monkeypatch.setattr(loading, "LISTED_KEYS", listed)
    draw = random.Random(3)
    loaded = some_orders(spark, draw.choices(range(400), k=200))
    for span in ((0, 400), (100, 120), (900, 950)):
        incoming = some_orders(spark, draw.choices(range(*span), k=60))
        near = loading.near_keys(loaded, incoming, "order_id")
        for found in (loading.key_conflicts, loading.new_rows):
            wanted = sorted(map(tuple, found(incoming, loaded, "order_id").collect()))
            assert sorted(map(tuple, found(incoming, near, "order_id").collect())) == wanted
    assert loading.near_keys(loaded, loaded.limit(0), "order_id").count() == 0


def test_a_search_for_keys_skips_what_cannot_have_them(spark, warehouse, monkeypatch):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    rng = random.Random(1)
    rows = some_orders(spark, [0]).drop("order_id").crossJoin(
        spark.createDataFrame([(rng.randrange(10**9) * 2,) for _ in range(4000)], "order_id long")
    )
    warehouse.append("orders", rows.coalesce(1))
    loaded = warehouse.table("orders")
    incoming = some_orders(spark, [2 * rng.randrange(10**9) + 1 for _ in range(20)])
    near = loading.near_keys(loaded, incoming, "order_id").select("order_id")
    assert "PushedFilters: [In(order_id" in near._jdf.queryExecution().executedPlan().toString()
    assert rows_scanned(near) == 0
    monkeypatch.setattr(loading, "LISTED_KEYS", 0)
    above = loading.near_keys(loaded, some_orders(spark, [3 * 10**9, 4 * 10**9]), "order_id")
    assert rows_scanned(above.select("order_id")) == 0
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def rows_scanned(df):
    """Rows that come out of the scan, before the filter looks at them."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(n).metrics().apply("numOutputRows").value() for n in range(leaves.size()))


def test_a_load_of_dimensions_counts_what_goes_by(spark, warehouse, tables):
    orders, stock = inputs.orders_raw(spark, tables), inputs.inventory_raw(spark, tables)
    counts = jobs.load_dimensions(warehouse, orders, stock)
    rows = dims.orders_dim(orders)
    assert counts["orders_dim"] == {
        "rows_read": orders.count(),
        "incomplete_read": nulls.null_rows(orders).count(),
        "rows_written": rows.count(),
        "no_value_written": rows.filter("total_order_value IS NULL").count(),
    }
    alerts = kpis.stock_alert_counts(dims.inventory_dim(stock)).first()
    written = counts["inventory_dim"]
    assert written["alerts_written"] == alerts.alerts > 0
    assert written["low_stock_written"] == alerts.low_stock
    nothing = jobs.load_dimensions(warehouse, orders.limit(0), stock.limit(0))
    assert set(nothing["orders_dim"].values()) | set(nothing["inventory_dim"].values()) == {0}
