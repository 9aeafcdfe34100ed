"""What Spark makes of the plans."""

from __future__ import annotations

import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from larderline.operators import joins, nulls
from larderline.plans import dims, kpis
from larderline.plans.facts import orders_fact
from larderline.plans.warehouse import Warehouse
from larderline.schemas import INVENTORY_DIM, ORDERS, ORDERS_DIM, ORDERS_FACT
from larder_checks.queries import QUERIES

# These write tables or start streams while they are built.
WRITES = {name for name in QUERIES if name.startswith(("stream_", "sink_", "csv_", "json_"))} | {
    "fact_append_twice",
    "fact_replace_days",
    "load_counts",
    "totals_summary",
    "table_statistics",
    "totals_daily_orders",
    "daily_orders_by_day",
    "show_tables",
    "orders_accepted",
    "orders_quarantine",
    "orders_load_job",
    "stored_tracking_within",
    "describe_table",
    "orders_table_roundtrip",
    "sql_orders_fact",
    "sql_daily_orders",
    "stored_volume_by_warehouse_item",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(autouse=True)
def whole_text(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.fixture(scope="module")
def stored_orders(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plan") / "orders")
    row = (1, 1, 1, 1, Decimal("1.00"), dt.datetime(2025, 1, 1), "ok")
    spark.createDataFrame([row], ORDERS).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_no_python_and_no_product_of_tables(spark, tables, name):
    text = plan(QUERIES[name](spark, tables))
    for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


def test_null_filter_reaches_the_file_scan(stored_orders):
    text = plan(nulls.drop_null_rows(stored_orders))
    for name in ORDERS.names:
        assert f"IsNotNull({name})" in text
    assert "PushedFilters: []" in plan(stored_orders.dropna())


def test_test_orders_go_before_the_shuffle(stored_orders):
    text = plan(dims.orders_dim(stored_orders))
    assert text.index("= test") > text.index("Exchange")
    assert text.count("Exchange hashpartitioning") == 1


def test_orders_with_a_key_need_no_shuffle(stored_orders):
    assert "Exchange" not in plan(dims.orders_dim(stored_orders, has_key=True))


def test_latest_days_need_no_full_sort(spark):
    orders = spark.createDataFrame([], ORDERS_DIM)
    inventory = spark.createDataFrame([], INVENTORY_DIM)
    text = plan(kpis.daily_orders(orders_fact(orders, inventory)))
    assert "TakeOrderedAndProject(limit=10, " in text


def test_latest_days_are_found_before_copies_are_removed(spark, stored_orders):
    inventory = spark.createDataFrame([], INVENTORY_DIM)
    text = plan(kpis.daily_orders_of(dims.orders_dim(stored_orders), inventory))
    lines = text.splitlines()
    copies = [n for n, line in enumerate(lines) if "HashAggregate" in line and "user_id" in line]
    days = next(n for n, line in enumerate(lines) if "LeftSemi" in line)
    assert len(copies) == 2
    assert days > max(copies)


def stored(spark, tmp_path, schema, name):
    path = str(tmp_path / name)
    spark.createDataFrame([], schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def test_figures_read_only_their_columns(spark, tmp_path):
    orders = stored(spark, tmp_path, ORDERS_DIM, "orders")
    inventory = stored(spark, tmp_path, INVENTORY_DIM, "inventory")
    text = plan(kpis.fact_count_of(orders, inventory))
    assert text.count("ReadSchema: struct<item_id:int>") == 2


def test_large_inventory_join_moves_one_row_per_item(spark, tmp_path, no_broadcast):
    orders = stored(spark, tmp_path, ORDERS_DIM, "orders")
    inventory = stored(spark, tmp_path, INVENTORY_DIM, "inventory")
    text = plan(kpis.volume_by_warehouse_item_of(orders, inventory))
    operators = re.findall(r"HashAggregate|Exchange|SortMergeJoin", text)
    # From the report's order down: groups, join, then both sides of the join,
    # where orders are counted per item before and after their only shuffle.
    assert operators == [
        *("Exchange", "HashAggregate", "Exchange", "HashAggregate", "SortMergeJoin"),
        *("HashAggregate", "Exchange", "HashAggregate"),
        "Exchange",
    ]


def test_joins_without_heavy_keys_are_plain(spark, tables):
    text = plan(QUERIES["courier_tracking"](spark, tables))
    assert "SortMergeJoin [courier_id" in text
    assert "explode" not in text and "Broadcast" not in text


def test_a_short_list_of_heavy_keys_is_broadcast_and_a_long_one_is_not(
    spark, monkeypatch, no_broadcast
):
    left = spark.range(4000).select((F.col("id") % 20).alias("k"), "id")
    right = spark.range(2000).select((F.col("id") % 20).alias("k"), F.col("id").alias("n"))
    short = joins.many_to_many(left, right, "k", pairs_per_task=1000)
    assert plan(short).count("BroadcastHashJoin") == 2
    monkeypatch.setattr(joins, "SHORT_LIST", 5)
    long = joins.many_to_many(left, right, "k", pairs_per_task=1000)
    assert "BroadcastExchange" not in plan(long)
    assert long.count() == short.count() == 20 * 200 * 100


def test_some_days_of_a_stored_fact_are_read_without_the_rest(spark, tmp_path):
    warehouse = Warehouse(spark, "pruned", str(tmp_path / "pruned")).create()
    day = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 1000).cast("int"))
    rows = spark.range(0, 400_000, numPartitions=1).select(
        *[
            (day if field.name == "order_date" else F.col("id")).cast(field.dataType).alias(field.name)
            for field in ORDERS_FACT
        ]
    )
    try:
        warehouse.replace("orders_fact", rows)
        table = warehouse.table("orders_fact")
        latest = table.filter(F.col("order_date") >= F.lit("2022-09-17").cast("date"))
        assert "PushedFilters: [IsNotNull(order_date), GreaterThanOrEqual(order_date" in plan(latest)
        assert latest.count() == 10 * 400
        assert rows_scanned(latest) < 40_000
    finally:
        warehouse.drop()


def test_the_small_side_of_a_join_is_known_from_statistics(spark, tmp_path):
    """Few stock rows of one warehouse: their bytes do not show it, counts do."""
    warehouse = Warehouse(spark, "known", str(tmp_path / "known")).create()
    names = {"warehouse": F.concat(F.lit("w"), F.col("id") % 500), "item_id": F.col("id")}
    stock = spark.range(20_000).select(
        *[names.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in INVENTORY_DIM]
    )
    dates = {"item_id": F.col("id") % 20_000}
    orders = spark.range(50_000).select(
        *[dates.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in ORDERS_DIM]
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "5000")
    try:
        warehouse.replace("inventory_dim", stock)
        warehouse.replace("orders_dim", orders)

        def joined():
            some = warehouse.table("inventory_dim").filter("warehouse = 'w7'")
            return plan(warehouse.table("orders_dim").join(some.select("item_id"), "item_id"))

        assert "SortMergeJoin" in joined()
        warehouse.analyze("inventory_dim", ["item_id", "warehouse"])
        assert warehouse.statistics("inventory_dim", "item_id")["max"] == "19999"
        assert "BroadcastHashJoin" in joined()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        warehouse.drop()


def rows_scanned(df):
    """Rows that come out of the scan, before the filter looks at them."""
    df.collect()
    plan_now = df._jdf.queryExecution().executedPlan()
    leaves = plan_now.collectLeaves()
    return leaves.apply(0).metrics().apply("numOutputRows").value()
