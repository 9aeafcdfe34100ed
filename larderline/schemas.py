"""Declared schemas of the source tables and of the warehouse tables.

All times are zone-less: the warehouse stores wall-clock timestamps, and dates
derived from them must not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)
# Quantity times price: holds any whole number times any amount of money.
ORDER_VALUE = T.DecimalType(22, 2)


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


def text_only(schema: T.StructType) -> T.StructType:
    """The same columns, all as text: how CSV files and JSON messages arrive."""
    return T.StructType([T.StructField(field.name, T.StringType()) for field in schema])


# Table and column names that every reader and writer agrees on.
ORDERS = _table(
    order_id=T.LongType(),
    user_id=T.LongType(),
    item_id=T.IntegerType(),
    quantity=T.IntegerType(),
    price=MONEY,
    order_ts=T.TimestampNTZType(),
    status=T.StringType(),
)

INVENTORY_DOCUMENT = _table(
    item_id=T.StringType(),
    name=T.StringType(),
    category=T.StringType(),
    Warehouse=T.StringType(),
    stock_level=T.StringType(),
    last_update=T.StringType(),
)

GPS_EVENT = _table(
    courier_id=T.StringType(),
    lat=T.DoubleType(),
    lon=T.DoubleType(),
    ts=T.LongType(),
)

STATUS_EVENT = _table(
    order_id=T.StringType(),
    courier_id=T.StringType(),
    status=T.StringType(),
    ts=T.LongType(),
)

ORDERS_DIM = _table(
    order_id=T.LongType(),
    user_id=T.LongType(),
    item_id=T.IntegerType(),
    quantity=T.IntegerType(),
    price=MONEY,
    order_ts=T.TimestampNTZType(),
    status=T.StringType(),
    total_order_value=ORDER_VALUE,
    order_date=T.DateType(),
)

INVENTORY_DIM = _table(
    item_id=T.IntegerType(),
    name=T.StringType(),
    category=T.StringType(),
    warehouse=T.StringType(),
    stock_level=T.IntegerType(),
    last_update=T.TimestampNTZType(),
    stock_flag=T.StringType(),
)

ORDERS_FACT = _table(
    order_id=T.LongType(),
    item_id=T.IntegerType(),
    name=T.StringType(),
    warehouse=T.StringType(),
    total_order_value=ORDER_VALUE,
    order_date=T.DateType(),
    stock_flag=T.StringType(),
)

# What the figures of the orders fact add up from, for each day.
ORDER_TOTALS = _table(
    order_date=T.DateType(),
    order_rows=T.LongType(),
    value_rows=T.LongType(),
    value_sum=T.DecimalType(38, 2),
)

GPS_DIM = _table(
    courier_id=T.StringType(),
    lat=T.DoubleType(),
    lon=T.DoubleType(),
    gps_ts=T.TimestampNTZType(),
)

STATUS_DIM = _table(
    order_id=T.IntegerType(),
    courier_id=T.StringType(),
    status=T.StringType(),
    status_ts=T.TimestampNTZType(),
)

COURIER_TRACKING = _table(
    courier_id=T.StringType(),
    order_id=T.IntegerType(),
    lat=T.DoubleType(),
    lon=T.DoubleType(),
    gps_ts=T.TimestampNTZType(),
    status=T.StringType(),
    status_ts=T.TimestampNTZType(),
)

WAREHOUSE_TABLES = {
    "orders_dim": ORDERS_DIM,
    "inventory_dim": INVENTORY_DIM,
    "orders_fact": ORDERS_FACT,
    "order_totals": ORDER_TOTALS,
    "gps_dim": GPS_DIM,
    "status_dim": STATUS_DIM,
    "courier_tracking": COURIER_TRACKING,
}


def _shape(schema: T.StructType) -> list[tuple[str, str]]:
    return [(field.name, field.dataType.simpleString()) for field in schema]


def require(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Return ``df`` if its names and types are the declared ones, in order."""
    if _shape(df.schema) != _shape(schema):
        raise ValueError(f"expected columns {_shape(schema)}, got {_shape(df.schema)}")
    return df
