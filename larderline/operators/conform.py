"""Bring columns to their declared names, types and spelling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larderline.functions.text import snake_case, standardized
from larderline.schemas import INVENTORY_DOCUMENT

# Fixed value: the status, after standardising, that marks a test order.
TEST_STATUS = "test"


def snake_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake_case(name) for name in df.columns])


def standardize(df: DataFrame, *names: str) -> DataFrame:
    """Lower-case and trim the named text columns. A column takes the spelling
    given here, so ``Warehouse`` standardised as ``warehouse`` is renamed."""
    spelling = {name.lower(): name for name in names}
    return df.select(
        *[
            standardized(F.col(f"`{name}`")).alias(spelling[name.lower()])
            if name.lower() in spelling
            else F.col(f"`{name}`")
            for name in df.columns
        ]
    )


def inventory_columns(documents: DataFrame) -> DataFrame:
    """The declared inventory columns in order; store-internal ones go."""
    return documents.select(*INVENTORY_DOCUMENT.names)


def cast_inventory(inventory: DataFrame) -> DataFrame:
    """Typed item, level and time. Malformed text becomes NULL under any ANSI
    setting; the row stays."""
    return inventory.withColumns(
        {
            "item_id": F.col("item_id").try_cast("int"),
            "stock_level": F.col("stock_level").try_cast("int"),
            "last_update": F.col("last_update").try_cast("timestamp_ntz"),
        }
    )


def drop_test_orders(orders: DataFrame) -> DataFrame:
    """Orders whose standardised status is not the test marker; an unknown
    status goes too."""
    return orders.filter(F.col("status") != TEST_STATUS)


def distinct_rows(df: DataFrame) -> DataFrame:
    """One of each group of equal rows. Copies collapse inside each map task
    before the shuffle, so a large group of copies stays cheap."""
    return df.dropDuplicates()
