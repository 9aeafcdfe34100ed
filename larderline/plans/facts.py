"""Fact tables out of dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larderline.functions.times import slot, timestamp_to_epoch, touched_slots
from larderline.operators.joins import PAIRS_PER_TASK, many_to_many, with_stock
from larderline.schemas import COURIER_TRACKING, ORDERS_FACT


def orders_fact(orders: DataFrame, inventory: DataFrame) -> DataFrame:
    """Each order with name, warehouse and flag of its item. An item with
    several stock rows repeats its orders; one with none gives NULLs."""
    return with_stock(
        orders.select("order_id", "item_id", "total_order_value", "order_date"),
        inventory.select("item_id", "name", "warehouse", "stock_flag"),
    ).select(*ORDERS_FACT.names)


def courier_tracking(
    gps: DataFrame, status: DataFrame, pairs_per_task: int = PAIRS_PER_TASK
) -> DataFrame:
    """Every position of a courier with every status event of that courier."""
    return many_to_many(gps, status, "courier_id", pairs_per_task).select(
        *COURIER_TRACKING.names
    )


def late_tracking(
    gps: DataFrame,
    status: DataFrame,
    late_gps: DataFrame,
    late_status: DataFrame,
    within_seconds: int,
) -> DataFrame:
    """The pairs that a stream over ``gps`` and ``status`` missed, because one of
    the two rows came late."""
    everything = status.unionByName(late_status)
    return courier_tracking_within(late_gps, everything, within_seconds).unionByName(
        courier_tracking_within(gps, late_status, within_seconds)
    )


def courier_tracking_within(
    gps: DataFrame,
    status: DataFrame,
    within_seconds: int,
    pairs_per_task: int = PAIRS_PER_TASK,
) -> DataFrame:
    """The pairs of ``courier_tracking`` at most so many seconds apart.

    Rows meet by courier and slot of time, so the pairs tried grow with the
    number of events and the bound, not with the square of a courier's history.
    """
    gps_second = timestamp_to_epoch(F.col("gps_ts"))
    status_second = timestamp_to_epoch(F.col("status_ts"))
    # Equal structs may hold equal NULLs, but an unknown courier meets nobody.
    meeting = F.struct("courier_id", "slot")
    known = F.col("courier_id").isNotNull()
    positions = gps.filter(known).withColumn("slot", slot(gps_second, within_seconds))
    touched = touched_slots(status_second, within_seconds)
    changes = status.filter(known).withColumn("slot", F.explode(touched))
    pairs = many_to_many(
        positions.withColumn("meeting", meeting).drop("slot"),
        changes.withColumn("meeting", meeting).drop("slot", "courier_id"),
        "meeting",
        pairs_per_task,
    )
    bound = F.expr(f"INTERVAL {int(within_seconds)} SECONDS")
    apart = F.col("gps_ts") - F.col("status_ts")
    return pairs.filter(F.abs(apart) <= bound).select(*COURIER_TRACKING.names)
