"""Stateful steps over cleaned event streams.

Cleaning itself needs no state: ``plans.dims.gps_dim`` and ``status_dim`` apply
to a stream as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderline.functions.times import slot, timestamp_to_epoch, touched_slots
from larderline.schemas import COURIER_TRACKING, STATUS_DIM


def _event_time(moment: str) -> Column:
    """The zone-less time as an instant, the only type a watermark takes."""
    return F.timestamp_seconds(timestamp_to_epoch(F.col(moment)))


def busy_couriers(
    positions: DataFrame, changes: DataFrame, share: float = 0.01
) -> DataFrame:
    """Couriers with at least ``share`` of the rows of a stored feed, and the
    numbers of parts that bring each feed of theirs below it. There are at most
    ``2 / share`` of them. Each feed is counted once, and in map tasks first."""

    def counted(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("courier_id").agg(F.count(F.lit(1)).alias(name))

    counts = counted(positions, "gps_rows").join(
        counted(changes, "status_rows"), "courier_id", "full"
    )
    counts = counts.fillna(0, ["gps_rows", "status_rows"])
    total = counts.agg(F.sum("gps_rows"), F.sum("status_rows")).first()

    def parts(name: str, rows: int | None) -> Column:
        part = max(1.0, share * (rows or 0))
        return F.greatest(F.lit(1), F.ceil(F.col(name) / part).cast("int"))

    return (
        counts.withColumn("gps_parts", parts("gps_rows", total[0]))
        .withColumn("status_parts", parts("status_rows", total[1]))
        .filter(F.col("courier_id").isNotNull())
        .filter((F.col("gps_parts") > 1) | (F.col("status_parts") > 1))
        .select("courier_id", "gps_parts", "status_parts")
    )


def _with_parts(events: DataFrame, courier: str, busy: DataFrame | None) -> DataFrame:
    names = ("gps_parts", "status_parts")
    if busy is None:
        return events.withColumns({name: F.lit(1) for name in names})
    listed = busy.withColumnRenamed("courier_id", courier)
    parts = {name: F.coalesce(name, F.lit(1)) for name in names}
    return events.join(listed, courier, "left").withColumns(parts)


def _dealt(events: DataFrame, own: str, other: str, seed: int) -> DataFrame:
    """Each row picks one part of its own feed and goes to all of the other's."""
    return (
        events.withColumn(f"own_{own}", F.floor(F.rand(seed) * F.col(own)).cast("int"))
        .withColumn(f"own_{other}", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        .drop(own, other)
    )


def track_couriers(
    gps: DataFrame,
    status: DataFrame,
    within_seconds: int,
    late_by: str,
    busy: DataFrame | None = None,
) -> DataFrame:
    """Positions of a courier with the status events of that courier at most
    ``within_seconds`` before or after.

    Without a time bound both sides would be kept for ever, so the stream has
    one where the batch fact has none. Time is cut into slots of twice the
    bound: a position belongs to one slot, a status event to the one or two its
    bound touches. Slots divide the history of a courier. Where one courier is
    busy at all times, list it in ``busy`` (see ``busy_couriers``): its positions
    are dealt out over the rows of a grid and its status events over the columns,
    and each pair meets in one cell. The list must stay the same for as long as a
    checkpoint is in use.

    Rows behind the watermark are dropped; ``late.split_late`` keeps them apart
    beforehand.

    The time test after the join is exact, and lets Spark drop state that the
    watermark has passed.
    """
    bound = F.expr(f"INTERVAL {int(within_seconds)} SECONDS")

    positions = (
        gps.withColumn("gps_time", _event_time("gps_ts"))
        .withWatermark("gps_time", late_by)
        .transform(_with_parts, "courier_id", busy)
        .withColumn("slot", slot(F.unix_seconds("gps_time"), within_seconds))
        .transform(_dealt, "gps_parts", "status_parts", 17)
    )
    touched = touched_slots(F.unix_seconds("status_time"), within_seconds)
    changes = (
        status.withColumnRenamed("courier_id", "status_courier_id")
        .withColumn("status_time", _event_time("status_ts"))
        .withWatermark("status_time", late_by)
        .transform(_with_parts, "status_courier_id", busy)
        .withColumn("status_slot", F.explode(touched))
        .transform(_dealt, "status_parts", "gps_parts", 23)
        .withColumnsRenamed({"own_gps_parts": "gps_row", "own_status_parts": "status_column"})
    )
    together = (
        (F.col("courier_id") == F.col("status_courier_id"))
        & (F.col("slot") == F.col("status_slot"))
        & (F.col("own_gps_parts") == F.col("gps_row"))
        & (F.col("own_status_parts") == F.col("status_column"))
        & (F.col("gps_time") >= F.col("status_time") - bound)
        & (F.col("gps_time") <= F.col("status_time") + bound)
    )
    return positions.join(changes, together).select(*COURIER_TRACKING.names)


def status_counts(status: DataFrame) -> DataFrame:
    """Running number of events per status. The state is one row per status,
    and events are counted inside each task before they are shuffled."""
    return status.groupBy("status").agg(F.count(F.lit(1)).alias("event_count"))


def without_repeats(status: DataFrame, late_by: str, splits: int | None = None) -> DataFrame:
    """Status events without redelivered copies.

    Copies are first removed within random splits, then across them. The first
    step lets several tasks share a very large group of copies and passes on
    one row per split; the second makes the result exact whatever the splits.
    There are as many splits as state partitions, unless said otherwise, so a
    group of copies is shared by more tasks where there are more.
    State older than the watermark is dropped in both, and so are rows that come
    later than that; ``late.split_late`` keeps them apart beforehand.
    """
    identity = STATUS_DIM.names
    if splits is None:
        splits = int(status.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        status.withColumn("status_time", _event_time("status_ts"))
        .withWatermark("status_time", late_by)
        .withColumn("split", F.floor(F.rand(19) * splits))
        .dropDuplicatesWithinWatermark([*identity, "split"])
        .dropDuplicatesWithinWatermark(identity)
        .select(*identity)
    )
