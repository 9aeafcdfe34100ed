"""Business figures.

Figures about the orders fact come in two forms. One reads a stored fact. The
other, named ``..._of``, takes the two dimensions and never builds the fact: it
first reduces orders to one row per item, so that the join with the inventory
moves a row per item instead of a row per order and no item is heavy any more.
Both give the same result.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderline.functions.labels import LOW_STOCK, OUT_OF_STOCK, needs_restock
from larderline.plans.warehouse import Warehouse

LATEST_DAYS = 10


def _rows() -> Column:
    return F.count(F.lit(1))


def _average(total: Column, number: Column) -> Column:
    """Average to four decimals, or NULL where there is nothing to average."""
    return F.round(total.cast("double") / F.nullif(number, F.lit(0)), 4)


# Figures that read a stored orders fact.


def _average_cart() -> Column:
    value = F.col("total_order_value")
    return _average(F.sum(value), F.count(value)).alias("avg_cart_value")


def fact_count(fact: DataFrame) -> DataFrame:
    return fact.agg(_rows().alias("row_count"))


def daily_orders(fact: DataFrame, days: int = LATEST_DAYS) -> DataFrame:
    """Order rows per day, the latest days first."""
    per_day = fact.groupBy("order_date").agg(_rows().alias("order_count"))
    return per_day.orderBy(F.desc("order_date")).limit(days)


def daily_orders_by_day(warehouse: Warehouse, days: int = LATEST_DAYS) -> DataFrame:
    """The same of a stored fact that is kept by day: of the other days no file
    is opened."""
    latest = warehouse.days("orders_fact")[:days]
    return daily_orders(warehouse.rows_of_days("orders_fact", latest), days)


def avg_cart_value(fact: DataFrame) -> DataFrame:
    return fact.agg(_average_cart())


def fact_summary(fact: DataFrame) -> DataFrame:
    """Row count and average cart value in one pass."""
    return fact.agg(_rows().alias("row_count"), _average_cart())


def _by_warehouse(volumes: DataFrame) -> DataFrame:
    return volumes.orderBy(F.asc_nulls_last("warehouse"), F.desc("volume"))


def volume_by_warehouse_item(fact: DataFrame) -> DataFrame:
    """Order rows per warehouse and item name, unmatched items last."""
    volumes = fact.groupBy("warehouse", "name").agg(_rows().alias("volume"))
    return _by_warehouse(volumes)


# The same figures from totals per day, which are kept as the fact grows.


def totals_of(fact: DataFrame) -> DataFrame:
    """What the figures add up from: a row per day."""
    value = F.col("total_order_value")
    return fact.groupBy("order_date").agg(
        _rows().alias("order_rows"),
        F.count(value).alias("value_rows"),
        F.coalesce(F.sum(value), F.lit(0)).cast("decimal(38,2)").alias("value_sum"),
    )


def added_totals(before: DataFrame, more: DataFrame) -> DataFrame:
    """Totals of two parts of a fact, put together."""
    sums = [
        F.sum(name).cast(kind).alias(name)
        for name, kind in before.dtypes
        if name != "order_date"
    ]
    return before.unionByName(more).groupBy("order_date").agg(*sums)


def summary_of_totals(totals: DataFrame) -> DataFrame:
    """Row count and average cart value."""
    average = _average(F.sum("value_sum"), F.sum("value_rows"))
    return totals.agg(
        F.coalesce(F.sum("order_rows"), F.lit(0)).alias("row_count"),
        average.alias("avg_cart_value"),
    )


def daily_orders_of_totals(totals: DataFrame, days: int = LATEST_DAYS) -> DataFrame:
    per_day = totals.select("order_date", F.col("order_rows").alias("order_count"))
    return per_day.orderBy(F.desc("order_date")).limit(days)


# The same figures straight from the dimensions.


def _with_matches(per_item: DataFrame, inventory: DataFrame) -> DataFrame:
    """Add the number of fact rows that one order of the item turns into."""
    matches = inventory.groupBy("item_id").agg(_rows().alias("stock_rows"))
    return (
        per_item.join(matches, "item_id", "left")
        .withColumn("matches", F.coalesce("stock_rows", F.lit(1)))
        .drop("stock_rows")
    )


def fact_count_of(orders: DataFrame, inventory: DataFrame) -> DataFrame:
    per_item = orders.groupBy("item_id").agg(_rows().alias("order_rows"))
    rows = F.sum(F.col("order_rows") * F.col("matches"))
    return _with_matches(per_item, inventory).agg(
        F.coalesce(rows, F.lit(0)).alias("row_count")
    )


def daily_orders_of(
    orders: DataFrame, inventory: DataFrame, days: int = LATEST_DAYS
) -> DataFrame:
    """The fact has the days of the orders, so the latest days are found first
    and the rest of the history is neither cleaned of copies nor joined."""
    latest = orders.select(F.col("order_date").alias("day")).distinct()
    latest = F.broadcast(latest.orderBy(F.desc("day")).limit(days))
    recent = orders.join(latest, F.col("order_date").eqNullSafe(F.col("day")), "left_semi")
    per_item = recent.groupBy("item_id", "order_date").agg(_rows().alias("order_rows"))
    per_day = (
        _with_matches(per_item, inventory)
        .groupBy("order_date")
        .agg(F.sum(F.col("order_rows") * F.col("matches")).alias("order_count"))
    )
    return per_day.orderBy(F.desc("order_date"))


def avg_cart_value_of(orders: DataFrame, inventory: DataFrame) -> DataFrame:
    value = F.col("total_order_value")
    per_item = orders.groupBy("item_id").agg(
        F.sum(value).alias("item_value"), F.count(value).alias("item_orders")
    )
    matches = F.col("matches")
    total = F.sum(F.col("item_value") * matches.cast("decimal(10,0)"))
    return _with_matches(per_item, inventory).agg(
        _average(total, F.sum(F.col("item_orders") * matches)).alias("avg_cart_value")
    )


def volume_by_warehouse_item_of(orders: DataFrame, inventory: DataFrame) -> DataFrame:
    per_item = orders.groupBy("item_id").agg(_rows().alias("order_rows"))
    volumes = (
        per_item.join(inventory.select("item_id", "warehouse", "name"), "item_id", "left")
        .groupBy("warehouse", "name")
        .agg(F.sum("order_rows").alias("volume"))
    )
    return _by_warehouse(volumes)


# Stock figures.


def stock_alerts(inventory: DataFrame) -> DataFrame:
    """Stock rows that are out or low."""
    return inventory.filter(needs_restock(F.col("stock_flag")))


def stock_alert_counts(inventory: DataFrame) -> DataFrame:
    """Alerts in total, out and low, in one pass."""
    flag = F.col("stock_flag")
    return inventory.agg(
        F.count_if(needs_restock(flag)).alias("alerts"),
        F.count_if(flag == OUT_OF_STOCK).alias("out_of_stock"),
        F.count_if(flag == LOW_STOCK).alias("low_stock"),
    )


# Columns that are empty where the source had something else: values that are
# no number, ids that are none, moments outside the calendar.
CHECKED_COLUMNS = {
    "orders_dim": ("total_order_value",),
    "inventory_dim": ("item_id", "stock_level", "last_update"),
    "gps_dim": ("gps_ts",),
    "status_dim": ("order_id", "status_ts"),
}


def quality_counts(**dimensions: DataFrame) -> DataFrame:
    """Per checked column of the named dimensions, the rows and those whose value
    could not be used. One pass over each dimension."""
    reports = []
    for name, table in dimensions.items():
        columns = CHECKED_COLUMNS[name]
        unusable = [F.count_if(F.col(column).isNull()).alias(column) for column in columns]
        lines = F.array(
            *[
                F.struct(
                    F.lit(name).alias("table_name"),
                    F.lit(column).alias("column_name"),
                    F.col("row_count"),
                    F.col(column).alias("unusable_rows"),
                )
                for column in columns
            ]
        )
        counted = table.agg(_rows().alias("row_count"), *unusable)
        reports.append(counted.select(F.inline(lines)))
    return functools.reduce(DataFrame.unionByName, reports)
