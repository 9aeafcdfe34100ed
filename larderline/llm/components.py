"""Connected components of a table of links, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larderline.llm.common import store
from larderline.workspace import drop_folder


def _large_star(links: DataFrame) -> DataFrame:
    """Hang each node's larger neighbours on the least of its neighbourhood."""
    both = links.union(links.select(F.col("low").alias("high"), F.col("high").alias("low")))
    node, neighbour = F.col("high"), F.col("low")
    least = both.groupBy(node).agg(F.least(node, F.min(neighbour)).alias("least"))
    larger = both.join(least, "high").filter(neighbour > node)
    return larger.select(neighbour.alias("high"), F.col("least").alias("low")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Hang each node and its smaller neighbours on the least of them."""
    least = links.groupBy("high").agg(F.min("low").alias("least"))
    smaller = links.join(least, "high").filter(F.col("low") != F.col("least"))
    hung = smaller.select(F.col("low").alias("high"), F.col("least").alias("low"))
    return hung.union(least.select("high", F.col("least").alias("low"))).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(
        links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("high", "low"))).first()
    )


def least_reachable(links: DataFrame) -> DataFrame:
    """``node`` and ``least``, the smallest node it reaches, for all linked nodes
    but the smallest ones themselves.

    ``links`` has two columns of whole numbers; order and repeats do not matter,
    links with NULL or to itself are ignored. A step groups and joins by node.
    Minima are taken in map tasks first, and the joins are plain inner ones that
    AQE splits, so a node with very many links is no heavy group. The number of
    rounds grows with the logarithm of the longest path; each is stored, in
    place of the one before.
    """
    first, second = links.columns
    spark = links.sparkSession
    links, path = store(
        links.select(
            F.greatest(first, second).alias("high"), F.least(first, second).alias("low")
        )
        .filter(F.col(first).isNotNull() & F.col(second).isNotNull())
        .filter(F.col("high") != F.col("low"))
        .distinct(),
        "links",
    )
    before, after = None, _state(links)
    while before != after:
        links, newer = store(_small_star(_large_star(links)), "links")
        drop_folder(spark, path)
        path, before, after = newer, after, _state(links)
    return links.select(F.col("high").alias("node"), F.col("low").alias("least"))
