"""Joins of orders with stock and of positions with status events.

Both may meet keys with very many rows on both sides. Such a key's output is the
product of its two sides, which its input bytes do not show, so a split by bytes
comes too late. The joins here deal the rows of such keys out over cells that
each produce a bounded number of pairs, and leave all other keys alone.

Every key that needs it is listed, and split as far as it needs. The list is made
when the join is put together: without heavy keys the join is a plain one, a short
list becomes a local table that is broadcast, and a long one is joined by shuffle,
in a left join, whose heavy side AQE splits.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Largest number of joined rows one cell of a heavy key should produce.
PAIRS_PER_TASK = 4_000_000
# Stock rows from which an item counts as wide. Below, a task that AQE has cut to
# size produces at most so many times the rows it reads.
WIDE_ITEM = 16
# Keys of a list that is brought to the driver and broadcast. A longer one stays
# a distributed table; the joined rows are the same.
SHORT_LIST = 10_000
# Cells that one array names; more are named by several arrays.
CELLS_AT_ONCE = 1000


def heavy_keys(
    left: DataFrame, right: DataFrame, key: str, pairs_per_task: int = PAIRS_PER_TASK
) -> DataFrame:
    """The keys that join into too many pairs for one task, with a grid to deal
    them out on: ``left_splits`` by ``right_splits`` cells.

    Both counts are partial aggregates, so the shuffle carries one row per key
    and task.
    """
    left_count = left.groupBy(key).agg(F.count(F.lit(1)).alias("left_rows"))
    right_count = right.groupBy(key).agg(F.count(F.lit(1)).alias("right_rows"))
    side = math.sqrt(pairs_per_task)
    pairs = F.col("left_rows").cast("double") * F.col("right_rows")
    left_splits = F.least("cells", F.ceil(F.col("left_rows") / side))
    columns_needed = F.ceil(F.col("cells") / F.col("left_splits"))
    right_splits = F.least(columns_needed, F.ceil(F.col("right_rows") / side))
    return (
        left_count.join(right_count, key)
        .withColumn("cells", F.ceil(pairs / pairs_per_task))
        .filter(F.col("cells") > 1)
        .withColumn("left_splits", left_splits)
        .withColumn("right_splits", right_splits)
        .select(key, "left_splits", "right_splits")
    )


def _listed(keys: DataFrame) -> DataFrame | None:
    """The list as the join should use it; None if it has no key."""
    rows = keys.limit(SHORT_LIST + 1).collect()
    if not rows:
        return None
    if len(rows) > SHORT_LIST:
        return keys
    return F.broadcast(keys.sparkSession.createDataFrame(rows, keys.schema))


def _or_one(splits: str) -> Column:
    return F.coalesce(splits, F.lit(1).cast("bigint"))


def _with_each_of(rows: DataFrame, splits: str, name: str) -> DataFrame:
    """A copy of each row for each number below ``splits``, in two steps, so
    that no array of numbers is long."""
    last = _or_one(splits) - 1
    starts = F.sequence(F.lit(0).cast("bigint"), last, F.lit(CELLS_AT_ONCE).cast("bigint"))
    block = F.sequence(F.col("_start"), F.least(F.col("_start") + CELLS_AT_ONCE - 1, last))
    return (
        rows.withColumn("_start", F.explode(starts))
        .withColumn(name, F.explode(block))
        .drop("_start")
    )


def _wide_items(
    orders: DataFrame, inventory: DataFrame, pairs_per_task: int, stock_rows: int
) -> DataFrame:
    """Items with many stock rows and so many orders that one task should not
    join them, with the number of cells for them. Orders are only counted for
    items wide enough, and not read at all where there is none."""
    wide = (
        inventory.groupBy("item_id")
        .agg(F.count(F.lit(1)).alias("stock_rows"))
        .filter(F.col("stock_rows") >= stock_rows)
    )
    pairs = F.col("order_rows").cast("double") * F.col("stock_rows")
    return (
        orders.groupBy("item_id")
        .agg(F.count(F.lit(1)).alias("order_rows"))
        .join(wide, "item_id")
        .withColumn("cells", F.ceil(pairs / pairs_per_task))
        .filter(F.col("cells") > 1)
        .select("item_id", "cells")
    )


def with_stock(
    orders: DataFrame,
    inventory: DataFrame,
    pairs_per_task: int = PAIRS_PER_TASK,
    wide_from: int = WIDE_ITEM,
) -> DataFrame:
    """Every order with the stock rows of its item, NULL where there is none.

    There is no join hint: Spark broadcasts the inventory where its size is
    under the broadcast threshold, and else shuffles both sides and splits an
    item with many orders at run time, which a left join allows. Only an item
    that also has many stock rows is dealt out here: its orders over cells, by
    a hash of the row so that a repeated task deals alike, and its stock rows to
    every cell, so that each order still meets all of them.
    """
    wide = _listed(_wide_items(orders, inventory, pairs_per_task, wide_from))
    if wide is None:
        return orders.join(inventory, "item_id", "left")
    order_cell = F.pmod(F.xxhash64(*orders.columns), _or_one("cells"))
    order_cells = orders.join(wide, "item_id", "left").withColumn("cell", order_cell)
    stock_cells = _with_each_of(inventory.join(wide, "item_id", "left"), "cells", "cell")
    joined = order_cells.drop("cells").join(stock_cells.drop("cells"), ["item_id", "cell"], "left")
    return joined.drop("cell")


def many_to_many(
    left: DataFrame, right: DataFrame, key: str, pairs_per_task: int = PAIRS_PER_TASK
) -> DataFrame:
    """Inner join on ``key`` where both sides hold many rows of a key.

    Rows of a heavy key are dealt out on a grid: a left row picks one grid row
    and goes to each column of it, a right row picks one column and goes to each
    row of it. Each pair meets in exactly one cell, so no pair is lost or
    doubled, and a key outside the list has a grid of one cell.

    The join is always a shuffled one. A broadcast would leave the output, many
    times its input, to the few tasks that happened to read the other side.

    Rows pick at random, because equal rows must spread as well, and they draw
    before anything is shuffled. The sides should be scans, stored tables, or
    plain projections and filters of those: then a repeated task draws the same
    numbers again. Stored Parquet tables are best, for counting the keys then
    reads one column of each.
    """
    heavy = _listed(heavy_keys(left, right, key, pairs_per_task))
    if heavy is None:
        return left.hint("merge").join(right, key)

    def drawn(rows: DataFrame, seed: int) -> DataFrame:
        return rows.withColumn("draw", F.rand(seed)).join(heavy, key, "left")

    def one_of(splits: str) -> Column:
        return F.floor(F.col("draw") * _or_one(splits))

    given = ["draw", "left_splits", "right_splits"]
    left_cells = drawn(left, seed=11).withColumn("grid_row", one_of("left_splits"))
    left_cells = _with_each_of(left_cells, "right_splits", "grid_column").drop(*given)
    right_cells = drawn(right, seed=13).withColumn("grid_column", one_of("right_splits"))
    right_cells = _with_each_of(right_cells, "left_splits", "grid_row").drop(*given)
    cell = ["grid_row", "grid_column"]
    return left_cells.hint("merge").join(right_cells, [key, *cell]).drop(*cell)
