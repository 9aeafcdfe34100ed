"""Business labels and values derived from order and inventory columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from larderline.schemas import ORDER_VALUE

# The first fragment found in a status decides its label.
STATUS_BY_FRAGMENT = (
    ("deliv", "delivered"),
    ("cancel", "cancelled"),
    ("process", "processing"),
    ("pending", "pending"),
    ("ship", "shipped"),
)

# Stock labels, and the level below which stock counts as low.
OUT_OF_STOCK = "Out of stock"
LOW_STOCK = "Low stock"
IN_STOCK = "In stock"
LOW_STOCK_BELOW = 20


def order_status(status: Column) -> Column:
    """One label per status family; a status of no family stays as it is."""
    families = [F.when(status.contains(part), label) for part, label in STATUS_BY_FRAGMENT]
    return F.coalesce(*families, status)


def stock_flag(level: Column, missing: str = IN_STOCK) -> Column:
    """Label a stock level. An unknown level counts as in stock unless
    ``missing`` names another label for it."""
    known = (
        F.when(level == 0, OUT_OF_STOCK)
        .when(level < LOW_STOCK_BELOW, LOW_STOCK)
        .when(level >= LOW_STOCK_BELOW, IN_STOCK)
    )
    return F.coalesce(known, F.lit(missing))


def needs_restock(flag: Column) -> Column:
    return flag.isin(OUT_OF_STOCK, LOW_STOCK)


def order_value(quantity: Column, price: Column) -> Column:
    """Quantity times price to the cent, in full."""
    return F.round(quantity * price, 2).cast(ORDER_VALUE)
