"""The jobs: each writes its tables once and reads figures from what it wrote."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from larderline.functions.labels import LOW_STOCK, OUT_OF_STOCK, needs_restock
from larderline.operators.conform import inventory_columns
from larderline.operators.inspection import require_flat, require_flat_texts
from larderline.operators.loading import all_orders_or_fail, key_conflicts, near_keys, new_rows
from larderline.operators.nulls import has_null
from larderline.plans import dims, kpis
from larderline.plans.warehouse import Warehouse, on_days
from larderline.workspace import prepare, staged

# Positions and status events further apart than this say nothing of each other.
TRACKING_SECONDS = 3600
# Columns by which dimensions are joined and filtered.
JOINED_COLUMNS = {
    "orders_dim": ("item_id", "order_date"),
    "inventory_dim": ("item_id", "warehouse"),
}


def load_orders(
    warehouse: Warehouse, text_rows: DataFrame, skip_loaded: bool = False
) -> None:
    """Add exported orders to the orders table.

    As with a primary key, nothing is added if a row does not parse or a key is
    taken or repeated. With ``skip_loaded`` rows of taken keys are left out
    instead. The rows come in one step, so a load that failed left none. Of what
    is loaded, only files are read that may hold one of the keys.
    """
    loaded = warehouse.table("orders")
    prepare(warehouse.spark, text_rows, loaded)
    # Typed once; checked and added from what was staged.
    with staged(all_orders_or_fail(text_rows), "orders") as incoming:
        loaded = near_keys(loaded, incoming, "order_id")
        if skip_loaded:
            incoming = new_rows(incoming, loaded, "order_id")
        refused = key_conflicts(incoming, loaded, "order_id").first()
        if refused is not None:
            raise ValueError(f"order {refused.order_id}: {refused.reason}; nothing was loaded")
        warehouse.append("orders", incoming)


# What is counted of a table's source and of the table while it is written.
Counts = dict[str, int]


def _counted(rows: DataFrame, **counts: Column) -> tuple[DataFrame, Observation]:
    """The rows, counted by the job that reads them."""
    seen = Observation()
    named = [F.count_if(condition).alias(name) for name, condition in counts.items()]
    return rows.observe(seen, F.count(F.lit(1)).alias("rows"), *named), seen


def _values(seen: Observation, names: Sequence[str]) -> Counts:
    try:
        return seen.get
    except Py4JJavaError:
        # The table was written; of rows that Spark knew to be none, it has no counts.
        return dict.fromkeys(names, 0)


def _found(
    read: Observation, written: Observation, of_source: Sequence[str], of_table: Sequence[str]
) -> Counts:
    before = _values(read, ["rows", *of_source])
    after = _values(written, ["rows", *of_table])
    return {f"{name}_read": n for name, n in before.items()} | {
        f"{name}_written": n for name, n in after.items()
    }


def load_dimensions(
    warehouse: Warehouse,
    orders: DataFrame,
    documents: DataFrame,
    null_policy: str = "drop",
    orders_have_key: bool = False,
    analyze: bool = False,
) -> dict[str, Counts]:
    """Replace the orders and inventory dimensions, and if asked have the catalog
    know the columns that joins and figures use (``JOINED_COLUMNS``).

    Returns what was read and written, by table, counted as it went by, so that
    each source is read once: ``rows``, ``incomplete`` rows of the source, order
    values that are unknown (``no_value``), and stock ``alerts`` in total,
    ``out_of_stock`` and ``low_stock``.
    """
    prepare(warehouse.spark, orders, documents)
    orders = require_flat(orders)
    source, orders_read = _counted(orders, incomplete=has_null(orders))
    rows = dims.orders_dim(source, null_policy, orders_have_key)
    rows, orders_written = _counted(rows, no_value=F.col("total_order_value").isNull())
    warehouse.replace("orders_dim", rows)
    stock = require_flat_texts(require_flat(inventory_columns(documents)))
    source, stock_read = _counted(stock, incomplete=has_null(stock))
    flag = F.col("stock_flag")
    rows, stock_written = _counted(
        dims.inventory_dim(source, null_policy),
        alerts=needs_restock(flag),
        out_of_stock=flag == OUT_OF_STOCK,
        low_stock=flag == LOW_STOCK,
    )
    warehouse.replace("inventory_dim", rows)
    if analyze:
        for table, columns in JOINED_COLUMNS.items():
            warehouse.analyze(table, columns)
    lacking, alerts = ["incomplete"], ["alerts", "out_of_stock", "low_stock"]
    return {
        "orders_dim": _found(orders_read, orders_written, lacking, ["no_value"]),
        "inventory_dim": _found(stock_read, stock_written, lacking, alerts),
    }


def load_event_dimensions(
    warehouse: Warehouse, gps_events: DataFrame, status_events: DataFrame
) -> None:
    """Replace the position and status dimensions."""
    prepare(warehouse.spark, gps_events, status_events)
    warehouse.replace("gps_dim", dims.gps_dim(gps_events))
    warehouse.replace("status_dim", dims.status_dim(status_events))


def load_facts(
    warehouse: Warehouse,
    within_seconds: int = TRACKING_SECONDS,
    unbounded_tracking: bool = False,
) -> None:
    """Rebuild both facts from the stored dimensions.

    Courier tracking holds the pairs at most ``within_seconds`` apart. All pairs
    of a courier, which grow with the square of its events, are built only if
    asked for. A run replaces the facts, so running it twice does not double
    them; use ``Warehouse.append`` where doubling is wanted.
    """
    prepare(warehouse.spark, *[warehouse.table(name) for name in kpis.CHECKED_COLUMNS])
    warehouse.replace("orders_fact", warehouse.build_orders_fact())
    warehouse.replace("order_totals", kpis.totals_of(warehouse.table("orders_fact")))
    bound = None if unbounded_tracking else within_seconds
    warehouse.replace("courier_tracking", warehouse.build_courier_tracking(bound))


def load_fact_days(
    warehouse: Warehouse, days: Collection[dt.date | None]
) -> None:
    """Rebuild some days of the orders fact, which is kept by day, from the stored
    dimensions, and the totals of these days. Running it again changes nothing."""
    prepare(warehouse.spark, warehouse.rows_of_days("orders_dim", days))
    warehouse.replace_days("orders_fact", warehouse.build_orders_fact(days), days)
    others = warehouse.table("order_totals").filter(~on_days("order_date", days))
    these = kpis.totals_of(warehouse.rows_of_days("orders_fact", days))
    warehouse.replace("order_totals", others.unionByName(these))


def append_facts(warehouse: Warehouse, rows: DataFrame) -> None:
    """Add rows to the orders fact, and what they add to the totals: the figures
    are kept without reading the fact again. As any append, running it twice
    counts the rows twice; ``load_facts`` rebuilds both."""
    prepare(warehouse.spark, rows)
    with staged(rows, "facts") as added:
        totals = kpis.added_totals(warehouse.table("order_totals"), kpis.totals_of(added))
        warehouse.append("orders_fact", added)
        warehouse.replace("order_totals", totals)


def stock_report(warehouse: Warehouse) -> DataFrame:
    """Alert counts of the stored inventory; reads one column."""
    return kpis.stock_alert_counts(warehouse.table("inventory_dim"))


def quality_report(warehouse: Warehouse) -> DataFrame:
    """Rows and unusable values of the stored dimensions."""
    return kpis.quality_counts(
        **{name: warehouse.table(name) for name in kpis.CHECKED_COLUMNS}
    )
