"""Keep events that come too late for a stateful step.

A stateful step drops rows behind its watermark without a trace. Here a stateless
query goes first: it writes events that the watermark would still let through to
one folder and the others to another. The stateful query reads the first folder,
from which nothing is dropped, and the second can be counted and caught up with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from larderline.functions.times import timestamp_to_epoch
from larderline.streaming.sinks import batch_writer
from larderline.workspace import newest_complete


def _folder(path: str, part: str, batch_id: int) -> str:
    return f"{path}/{part}/batch_id={batch_id}"


def split_late(
    stream: DataFrame,
    moment: str,
    late_by_seconds: int,
    path: str,
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Write each batch's rows below ``path``: to ``late`` what lies further than
    the bound behind the newest event so far, that of the batch included, and
    the rest to ``on_time``. Rows without a time are on time.

    A batch that was written whole is left alone when it runs again, so that a
    reader of the folder never meets its rows twice.
    """

    def split(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if newest_complete(spark, [_folder(path, "newest", batch_id)]):
            return
        batch.persist()
        try:
            second = timestamp_to_epoch(F.col(moment))
            seen = [batch.agg(F.max(second)).first()[0]]
            if batch_id and newest_complete(spark, [_folder(path, "newest", batch_id - 1)]):
                before = spark.read.parquet(_folder(path, "newest", batch_id - 1))
                seen.append(before.first()["second"])
            newest = max((s for s in seen if s is not None), default=None)
            limit = F.lit(newest).cast("long") - late_by_seconds
            is_late = F.coalesce(second < limit, F.lit(False))
            parts = {"late": batch.filter(is_late), "on_time": batch.filter(~is_late)}
            for part, rows in parts.items():
                rows.write.mode("overwrite").parquet(_folder(path, part, batch_id))
            state = spark.range(1).select(F.lit(newest).cast("long").alias("second"))
            # Written last: it says that the batch is whole.
            state.write.mode("overwrite").parquet(_folder(path, "newest", batch_id))
        finally:
            batch.unpersist()

    return batch_writer(stream, "append", checkpoint, every).foreachBatch(split).start()


def on_time(
    spark: SparkSession, path: str, like: DataFrame, files_per_batch: int | None = None
) -> DataFrame:
    """The stream of rows that ``split_late`` let through, in the order of its
    batches. A step with the same bound drops none of them."""
    reader = spark.readStream.schema(like.schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{path}/on_time").select(*like.columns)


def on_time_rows(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The rows that came in time, so far, as a table."""
    return spark.read.schema(like.schema).parquet(f"{path}/on_time").select(*like.columns)


def late_rows(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The rows that came too late, so far."""
    return spark.read.schema(like.schema).parquet(f"{path}/late").select(*like.columns)
