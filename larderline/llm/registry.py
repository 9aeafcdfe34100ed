"""Where the queries of this subpackage are registered, with their SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from larderline.llm.common import equip

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def registered(query: Query) -> Query:
    @functools.wraps(query)
    def equipped(spark: SparkSession, folder: str) -> DataFrame:
        equip(spark)
        return query(spark, folder)

    QUERIES[query.__name__] = equipped
    return equipped


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
