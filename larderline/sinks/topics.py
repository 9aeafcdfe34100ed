"""Publish events as JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_messages(events: DataFrame) -> DataFrame:
    """One column ``value``: each event as a JSON object."""
    return events.select(F.to_json(F.struct("*")).alias("value"))


def publish(events: DataFrame, servers: str, topic: str) -> None:
    """Send the events to a broker topic."""
    (
        as_messages(events)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def publish_to_folder(events: DataFrame, path: str) -> None:
    """Append the messages to a folder that stands in for a topic."""
    as_messages(events).write.mode("append").text(path)
