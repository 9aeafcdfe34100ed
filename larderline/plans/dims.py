"""Dimension tables out of source-shaped inputs.

The event dimensions are projections and filters only, so the same functions
serve files and streams.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larderline.functions.labels import IN_STOCK, order_status, order_value, stock_flag
from larderline.functions.times import epoch_to_timestamp
from larderline.operators.conform import (
    cast_inventory,
    distinct_rows,
    drop_test_orders,
    inventory_columns,
    snake_case_columns,
    standardize,
)
from larderline.operators.nulls import INVENTORY_DEFAULTS, ORDER_DEFAULTS, apply_null_policy
from larderline.schemas import GPS_DIM, INVENTORY_DIM, ORDERS_DIM, STATUS_DIM


def orders_dim(
    orders: DataFrame, null_policy: str = "drop", has_key: bool = False
) -> DataFrame:
    """Complete, distinct, real orders with value and date.

    Copies are removed before statuses are grouped into families: two rows that
    only then become equal are two orders. Where the source enforces a key
    there are no copies, and ``has_key`` saves the only shuffle.
    """
    complete = apply_null_policy(orders, null_policy, ORDER_DEFAULTS)
    standard = complete.transform(standardize, "status")
    distinct = standard if has_key else distinct_rows(standard)
    return (
        distinct.transform(drop_test_orders)
        .transform(snake_case_columns)
        .withColumns(
            {
                "order_ts": F.col("order_ts").cast("timestamp_ntz"),
                "status": order_status(F.col("status")),
                "total_order_value": order_value(F.col("quantity"), F.col("price")),
                "order_date": F.to_date("order_ts"),
            }
        )
        .select(*ORDERS_DIM.names)
    )


def inventory_dim(
    documents: DataFrame, null_policy: str = "drop", missing_level: str = IN_STOCK
) -> DataFrame:
    """Complete, distinct stock rows with a stock flag.

    Values are cast after incomplete rows went, so a level that is no number is
    unknown here; ``missing_level`` is the flag such a row gets.
    """
    return (
        documents.transform(inventory_columns)
        .transform(apply_null_policy, null_policy, INVENTORY_DEFAULTS)
        .transform(cast_inventory)
        .transform(standardize, "name", "category", "warehouse")
        .transform(distinct_rows)
        .transform(snake_case_columns)
        .withColumn("stock_flag", stock_flag(F.col("stock_level"), missing_level))
        .select(*INVENTORY_DIM.names)
    )


def gps_dim(events: DataFrame) -> DataFrame:
    """Courier positions with both coordinates."""
    return (
        events.select(
            F.lower("courier_id").alias("courier_id"),
            F.col("lat").try_cast("double").alias("lat"),
            F.col("lon").try_cast("double").alias("lon"),
            epoch_to_timestamp(F.col("ts")).alias("gps_ts"),
        )
        .filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
        .select(*GPS_DIM.names)
    )


def status_dim(events: DataFrame) -> DataFrame:
    """Order status events; one with a malformed order id stays, without it."""
    return events.select(
        F.col("order_id").try_cast("int").alias("order_id"),
        F.lower("courier_id").alias("courier_id"),
        F.lower("status").alias("status"),
        epoch_to_timestamp(F.col("ts")).alias("status_ts"),
    ).select(*STATUS_DIM.names)
