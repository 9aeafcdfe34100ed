"""Read tables of relational databases and collections of document stores."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Rows a connection brings at a time; some drivers else hold a whole range.
ROWS_PER_FETCH = 10_000


def jdbc_options(
    url: str,
    table: str,
    properties: Mapping[str, str],
    key: str | None = None,
    bounds: tuple[int, int] | None = None,
    connections: int = 8,
) -> dict[str, str]:
    """Options of a table scan. With a numeric ``key`` and its bounds the scan
    runs as that many range queries instead of one. The bounds only place the
    ranges: rows outside them are read as well."""
    options = {
        "url": url,
        "dbtable": table,
        "preferTimestampNTZ": "true",
        "fetchsize": str(ROWS_PER_FETCH),
        **properties,
    }
    if (key is None) != (bounds is None):
        raise ValueError("a partitioned scan needs both the key and its bounds")
    if key is not None and bounds is not None:
        options |= {
            "partitionColumn": key,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(connections),
        }
    return options


def read_jdbc(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def key_bounds(
    spark: SparkSession, url: str, table: str, properties: Mapping[str, str], key: str
) -> tuple[int, int] | None:
    """Smallest and largest key, as the database finds them; NULL if empty."""
    query = f"(SELECT MIN({key}) AS low, MAX({key}) AS high FROM {table}) key_bounds"
    low, high = read_jdbc(spark, jdbc_options(url, query, properties)).first()
    return None if low is None else (int(low), int(high))


def read_collection(
    spark: SparkSession, uri: str, database: str, collection: str
) -> DataFrame:
    """A collection through the document connector that the cluster provides."""
    return (
        spark.read.format("mongodb")
        .option("connection.uri", uri)
        .option("database", database)
        .option("collection", collection)
        .load()
    )
