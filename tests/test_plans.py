"""Dimensions, facts, the warehouse and the jobs on small tables."""

from __future__ import annotations

import datetime as dt
import uuid
from decimal import Decimal

import pytest

from larderline.plans import dims, facts, jobs, kpis
from larderline.plans.warehouse import Warehouse
from larderline.schemas import (
    COURIER_TRACKING,
    GPS_DIM,
    GPS_EVENT,
    INVENTORY_DIM,
    INVENTORY_DOCUMENT,
    ORDERS,
    ORDERS_DIM,
    ORDERS_FACT,
    STATUS_DIM,
    STATUS_EVENT,
    WAREHOUSE_TABLES,
    require,
    text_only,
)
from larder_checks import inputs

NOON = dt.datetime(2025, 7, 1, 12)
PRICE = Decimal("10.00")


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, f"test_{uuid.uuid4().hex[:8]}", str(tmp_path)).create()


def orders(spark, *rows):
    return spark.createDataFrame(rows, ORDERS)


def inventory(spark, *rows):
    return spark.createDataFrame(rows, INVENTORY_DOCUMENT)


def test_declared_schemas(spark):
    raw_orders = orders(spark, (1, 1, 1, 1, PRICE, NOON, "ok"))
    raw_stock = inventory(spark, ("1", "a", "b", "c", "4", "2025-07-01 08:00:00"))
    gps = spark.createDataFrame([("C001", "1", "2", "0")], text_only(GPS_EVENT))
    status = spark.createDataFrame([("1", "C001", "NEW", "0")], text_only(STATUS_EVENT))
    order_rows = require(dims.orders_dim(raw_orders), ORDERS_DIM)
    stock_rows = require(dims.inventory_dim(raw_stock), INVENTORY_DIM)
    positions = require(dims.gps_dim(gps), GPS_DIM)
    changes = require(dims.status_dim(status), STATUS_DIM)
    require(facts.orders_fact(order_rows, stock_rows), ORDERS_FACT)
    require(facts.courier_tracking(positions, changes), COURIER_TRACKING)
    with pytest.raises(ValueError, match="expected columns"):
        require(raw_orders, ORDERS_DIM)


def test_copies_go_before_statuses_are_grouped(spark):
    rows = [(1, 1, 1, 2, PRICE, NOON, s) for s in ("Delivered", " delivered ", "deliv")]
    result = dims.orders_dim(orders(spark, *rows)).collect()
    assert [row.status for row in result] == ["delivered", "delivered"]


def test_incomplete_orders_go_or_are_filled(spark):
    raw = orders(spark, (1, 1, 1, None, PRICE, NOON, "ok"), (2, 1, 1, 3, PRICE, NOON, None))
    assert dims.orders_dim(raw).count() == 0
    filled = {row.order_id: row for row in dims.orders_dim(raw, null_policy="fill").collect()}
    assert filled[1].total_order_value == 0
    assert filled[2].status == "unknown"


def test_cleaning_clean_orders_only_removes_new_copies(spark, tables):
    once = dims.orders_dim(inputs.orders_raw(spark, tables))
    twice = dims.orders_dim(once.select(*ORDERS.names))
    assert twice.count() == once.distinct().count() <= once.count()
    assert twice.exceptAll(once).isEmpty()


def test_order_columns(spark):
    row = dims.orders_dim(orders(spark, (1, 2, 3, 4, PRICE, NOON, " SHIPPING "))).first()
    assert row.asDict() == {
        "order_id": 1,
        "user_id": 2,
        "item_id": 3,
        "quantity": 4,
        "price": PRICE,
        "order_ts": NOON,
        "status": "shipped",
        "total_order_value": Decimal("40.00"),
        "order_date": dt.date(2025, 7, 1),
    }


def test_level_that_is_no_number(spark):
    raw = inventory(spark, ("1", "a", "b", "c", "n/a", "2025-07-01 08:00:00"))
    assert dims.inventory_dim(raw).first().stock_flag == "In stock"
    assert dims.inventory_dim(raw, missing_level="Unknown").first().stock_flag == "Unknown"


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_event_text_never_fails_a_job(spark, ansi):
    gps = spark.createDataFrame(
        [("C001", "bad", "2", "0"), ("C002", "", "2", "0"), (" C001", "1", "2", "never")],
        text_only(GPS_EVENT),
    )
    status = spark.createDataFrame([("x", "C001", "NEW", "0")], text_only(STATUS_EVENT))
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        positions = [tuple(row) for row in dims.gps_dim(gps).collect()]
        changes = [tuple(row) for row in dims.status_dim(status).collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert positions == [(" c001", 1.0, 2.0, None)]
    assert changes == [(None, "c001", "new", dt.datetime(1970, 1, 1))]


def test_every_position_meets_every_status(spark):
    gps = spark.createDataFrame([("c1", 1.0, 2.0, NOON)] * 2, GPS_DIM)
    status = spark.createDataFrame(
        [(i, "c1", "new", NOON) for i in range(3)] + [(9, "c2", "new", NOON)], STATUS_DIM
    )
    assert facts.courier_tracking(gps, status).count() == 6


@pytest.mark.parametrize("pairs_per_task", [1, 1000])
def test_tracking_within_a_bound(spark, pairs_per_task):
    def at(seconds):
        return NOON + dt.timedelta(seconds=seconds)

    gps = spark.createDataFrame(
        [("c1", 1.0, 2.0, at(s)) for s in (0, 0, 59, 60, 61, 3600)]
        + [(None, 1.0, 2.0, at(0)), ("c1", 1.0, 2.0, None)],
        GPS_DIM,
    )
    status = spark.createDataFrame(
        [(1, "c1", "new", at(0)), (2, "c1", "new", at(120)), (3, None, "new", at(0))]
        + [(4, "c1", "new", None), (5, "c2", "new", at(0))],
        STATUS_DIM,
    )
    near = facts.courier_tracking_within(gps, status, 60, pairs_per_task)
    pairs = sorted((row.order_id, (row.gps_ts - NOON).seconds) for row in near.collect())
    assert pairs == [(1, 0), (1, 0), (1, 59), (1, 60), (2, 60), (2, 61)]


def test_unmatched_items_come_last(spark):
    order_rows = dims.orders_dim(
        orders(spark, *[(i, 1, i, 1, PRICE, NOON, "ok") for i in (1, 2)])
    )
    stock = dims.inventory_dim(
        inventory(spark, ("1", "Ring", "x", "East", "4", "2025-07-01 08:00:00"))
    )
    volumes = kpis.volume_by_warehouse_item(facts.orders_fact(order_rows, stock)).collect()
    assert [tuple(row) for row in volumes] == [("east", "ring", 1), (None, None, 1)]


def test_figures_of_nothing(spark):
    fact = spark.createDataFrame([], ORDERS_FACT)
    assert kpis.fact_count(fact).first()[0] == 0
    assert kpis.avg_cart_value(fact).first()[0] is None
    no_orders = spark.createDataFrame([], ORDERS_DIM)
    no_stock = spark.createDataFrame([], INVENTORY_DIM)
    assert kpis.fact_count_of(no_orders, no_stock).first()[0] == 0
    assert kpis.avg_cart_value_of(no_orders, no_stock).first()[0] is None


def test_alerts_add_up(spark, tables):
    stock = dims.inventory_dim(inputs.inventory_raw(spark, tables))
    counts = kpis.stock_alert_counts(stock).first()
    assert counts.alerts == counts.out_of_stock + counts.low_stock
    assert counts.alerts == kpis.stock_alerts(stock).count() > 0


def load_all(spark, warehouse, tables):
    jobs.load_dimensions(
        warehouse, inputs.orders_raw(spark, tables), inputs.inventory_raw(spark, tables)
    )
    jobs.load_event_dimensions(
        warehouse, inputs.gps_raw(spark, tables), inputs.status_raw(spark, tables)
    )
    jobs.load_facts(warehouse)


def test_jobs_replace_and_sql_reads(spark, warehouse, tables):
    load_all(spark, warehouse, tables)
    first = sorted(map(tuple, warehouse.tables().collect()))
    load_all(spark, warehouse, tables)
    assert sorted(map(tuple, warehouse.tables().collect())) == first

    fact = warehouse.table("orders_fact")
    figures = spark.sql(
        f"SELECT count(*) AS row_count, round(avg(total_order_value), 4) AS average "
        f"FROM {warehouse.name('orders_fact')}"
    ).first()
    assert figures.row_count == kpis.fact_count(fact).first().row_count
    assert float(figures.average) == pytest.approx(kpis.avg_cart_value(fact).first()[0], abs=1e-3)
    assert jobs.stock_report(warehouse).first().alerts > 0


def test_facts_are_at_least_as_many_as_orders(spark, warehouse, tables):
    load_all(spark, warehouse, tables)
    counts = {row.table_name: row.row_count for row in warehouse.tables().collect()}
    assert counts["orders_fact"] > counts["orders_dim"]


def test_insert_statement_appends(spark, warehouse):
    statement = (
        f"INSERT INTO {warehouse.name('orders_fact')} (order_id, total_order_value) "
        "VALUES (1, 5.00)"
    )
    spark.sql(statement)
    spark.sql(statement)
    fact = warehouse.table("orders_fact")
    assert kpis.fact_count(fact).first()[0] == 2
    assert kpis.avg_cart_value(fact).first()[0] == 5.0


def test_failed_replacement_keeps_the_old_table(spark, warehouse):
    good = dims.status_dim(
        spark.createDataFrame([("1", "C001", "NEW", "0")], text_only(STATUS_EVENT))
    )
    warehouse.replace("status_dim", good)
    broken = good.selectExpr(
        "order_id", "courier_id", "raise_error('broken') AS status", "status_ts"
    )
    broken = broken.withColumn("status", broken.status.cast("string"))
    with pytest.raises(Exception, match="broken"):
        warehouse.replace("status_dim", broken)
    assert warehouse.table("status_dim").count() == 1


def test_loads_alternate_between_two_folders(spark, warehouse, tmp_path):
    rows = spark.createDataFrame([("1", "C001", "NEW", "0")], text_only(STATUS_EVENT))
    for number in range(1, 4):
        numbered = dims.status_dim(rows.withColumn("order_id", rows.ts + number))
        warehouse.replace("status_dim", numbered)
        assert warehouse.table("status_dim").first().order_id == number
    assert sorted(p.name for p in (tmp_path / "status_dim").iterdir()) == ["load-a", "load-b"]


def test_tables_are_found_without_their_catalog(spark, warehouse):
    rows = spark.createDataFrame([("1", "C001", "NEW", "0")], text_only(STATUS_EVENT))
    for _ in range(2):
        warehouse.replace("status_dim", dims.status_dim(rows))
        again = Warehouse(spark, f"test_{uuid.uuid4().hex[:8]}", warehouse.root).create()
        assert again.table("status_dim").count() == 1
    assert again.table("gps_dim").count() == 0


def test_views_are_not_listed_as_tables(spark, warehouse):
    spark.range(3).createOrReplaceTempView("some_view")
    listed = [row.table_name for row in warehouse.tables().collect()]
    assert listed == sorted(["orders", *WAREHOUSE_TABLES])
    spark.catalog.dropTempView("some_view")


def test_describe_shows_declared_columns(warehouse):
    described = [row.col_name for row in warehouse.describe("orders").collect()]
    assert described == ORDERS.names


def test_order_load_is_all_or_nothing(spark, warehouse):
    def text(*keys):
        rows = [(k, "2", "3", "4", "5.25", "2025-07-01T08:00:00Z", "new") for k in keys]
        return spark.createDataFrame(rows, text_only(ORDERS))

    jobs.load_orders(warehouse, text("1", "2"))
    with pytest.raises(ValueError, match="loaded before"):
        jobs.load_orders(warehouse, text("2", "3"))
    with pytest.raises(ValueError, match="repeated"):
        jobs.load_orders(warehouse, text("4", "4"))
    assert warehouse.table("orders").count() == 2
    jobs.load_orders(warehouse, text("2", "3"), skip_loaded=True)
    assert sorted(row.order_id for row in warehouse.table("orders").collect()) == [1, 2, 3]
