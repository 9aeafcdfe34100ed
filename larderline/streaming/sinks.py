"""Start streaming queries.

Without ``every`` a query processes what is there and stops; with it, it goes on
and looks for new events at that interval. Either way a restart with the same
checkpoint continues where the last run ended.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from larderline.workspace import newest_complete


def batch_writer(
    stream: DataFrame, mode: str, checkpoint: str, every: str | None
) -> DataStreamWriter:
    """Writes what is there and stops, or goes on at the interval."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if every is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=every)


def append_to_folder(
    stream: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Add new rows to a Parquet folder, each exactly once."""
    return batch_writer(stream, "append", checkpoint, every).format("parquet").start(path)


def load_batches(
    stream: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Load each batch into a sub-folder named by its number. A batch that runs
    again after a failure replaces its rows."""

    def load(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return batch_writer(stream, "append", checkpoint, every).foreachBatch(load).start()


def keep_latest(
    stream: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Write the complete result after each batch, for ``read_latest``; for small
    running totals. Batches take turns with two folders, so the last result that
    was written whole stays while the next one is written."""

    def replace(batch: DataFrame, _batch_id: int) -> None:
        current = newest_complete(batch.sparkSession, _turns(path))
        first, second = _turns(path)
        batch.write.mode("overwrite").parquet(second if current == first else first)

    return batch_writer(stream, "complete", checkpoint, every).foreachBatch(replace).start()


def _turns(path: str) -> tuple[str, str]:
    return f"{path}/total-a", f"{path}/total-b"


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The last complete result that ``keep_latest`` has written."""
    current = newest_complete(spark, _turns(path))
    if current is None:
        raise FileNotFoundError(f"no result yet in {path}")
    return spark.read.parquet(current)


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that the query's stateful steps dropped behind the watermark, in the
    batches it still reports on."""
    return sum(
        step["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for step in progress["stateOperators"]
    )


def stored_state(
    spark: SparkSession, checkpoint: str, step: int = 0, side: str | None = None
) -> DataFrame:
    """What a query's stateful step keeps, as its checkpoint has it: ``key``,
    ``value`` and ``partition_id``. A join has two sides, ``left`` and ``right``."""
    reader = spark.read.format("statestore").option("operatorId", step)
    if side is not None:
        reader = reader.option("joinSide", side)
    return reader.load(checkpoint)


def state_sizes(stored: DataFrame) -> DataFrame:
    """Rows and different keys of a state by partition, to see whether one is hot."""
    return stored.groupBy("partition_id").agg(
        F.count(F.lit(1)).alias("state_rows"), F.count_distinct("key").alias("state_keys")
    )
