"""Event topics as streams of JSON messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larderline.schemas import GPS_EVENT, STATUS_EVENT, text_only


def topic_stream(
    spark: SparkSession, servers: str, topic: str, offsets_per_batch: int | None = None
) -> DataFrame:
    """The messages of a broker topic from its start, as text in ``value``."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if offsets_per_batch is not None:
        reader = reader.option("maxOffsetsPerTrigger", offsets_per_batch)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def folder_stream(
    spark: SparkSession, path: str, files_per_batch: int | None = None
) -> DataFrame:
    """The messages in a folder of text files, as they arrive."""
    reader = spark.readStream.schema("value string").format("text")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


# Holds a message that is no JSON object.
_UNPARSED = "_message_as_it_came"


def _events(messages: DataFrame, schema: T.StructType) -> DataFrame:
    marked = T.StructType([*text_only(schema), T.StructField(_UNPARSED, T.StringType())])
    options = {"columnNameOfCorruptRecord": _UNPARSED}
    return messages.select("value", F.from_json("value", marked, options).alias("event"))


def _is_parsed() -> Column:
    return F.col("event").isNotNull() & F.col(f"event.{_UNPARSED}").isNull()


def _parsed(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """The fields as text, just as CSV files deliver them: an id sent as a
    string and a coordinate sent as a number both come through. Messages that
    are no JSON object are left out; ``unparsed`` has them."""
    events = _events(messages, schema).filter(_is_parsed())
    return events.select(*[f"event.{name}" for name in schema.names])


def unparsed(messages: DataFrame) -> DataFrame:
    """The messages that are no JSON object, as they came in ``value``."""
    return _events(messages, GPS_EVENT).filter(~_is_parsed()).select("value")


def gps_events(messages: DataFrame) -> DataFrame:
    return _parsed(messages, GPS_EVENT)


def status_events(messages: DataFrame) -> DataFrame:
    return _parsed(messages, STATUS_EVENT)
