"""Heavy keys: whole results, spread over tasks."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from larderline.operators.joins import heavy_keys, many_to_many, with_stock
from larderline.plans import kpis
from larderline.plans.facts import orders_fact


@pytest.fixture(scope="module")
def sides(spark):
    """One courier has a third of all rows, in copies; others a few each."""
    hot = F.when(F.col("id") % 3 == 0, "c000").otherwise(
        F.concat(F.lit("c"), (F.col("id") % 97 + 1).cast("string"))
    )
    value = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    left = spark.range(3000).select(hot.alias("courier_id"), value.alias("position"))
    right = spark.range(1500).select(hot.alias("courier_id"), value.alias("event"))
    return left, right


def tally(df):
    return sorted(map(repr, df.groupBy(*df.columns).count().collect()))


def test_heavy_keys_are_fine_grained(sides):
    left, right = sides
    grid = heavy_keys(left, right, "courier_id", pairs_per_task=10_000).collect()
    assert [row.courier_id for row in grid] == ["c000"]
    assert grid[0].left_splits * grid[0].right_splits >= 1000 * 500 / 10_000


@pytest.mark.parametrize("pairs_per_task", [100, 10_000, 4_000_000])
def test_no_pair_is_lost_or_doubled(sides, pairs_per_task):
    left, right = sides
    spread = many_to_many(left, right, "courier_id", pairs_per_task)
    assert tally(spread) == tally(left.join(right, "courier_id"))


def test_a_key_is_split_as_far_as_it_needs(spark):
    left = spark.range(200_000).select(F.lit("a").alias("k"))
    right = spark.range(100).select(F.lit("a").alias("k"), "id")
    grid = heavy_keys(left, right, "k", pairs_per_task=1).first()
    assert (grid.left_splits, grid.right_splits) == (200_000, 100)
    # 2,500 cells a row of the other side, named by several arrays.
    few = left.limit(2500)
    spread = many_to_many(few.withColumn("n", F.lit(1)), right.limit(2), "k", pairs_per_task=1)
    assert spread.count() == 5000


def test_all_heavy_keys_are_spread_however_many(spark):
    """More than ten thousand keys, each heavy, and three far heavier than the
    rest; none is left whole."""
    key = (F.col("id") % 12_000).alias("k")
    left = spark.range(48_000).select(key, "id")
    right = spark.range(36_000).select(key, F.col("id").alias("other"))
    hot = spark.range(3000).select((F.col("id") % 3 - 3).alias("k"), "id")
    left, right = left.union(hot), right.union(hot)
    grid = heavy_keys(left, right, "k", pairs_per_task=4)
    assert grid.count() == 12_003
    assert grid.filter("left_splits * right_splits < 3").isEmpty()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spread = many_to_many(left, right, "k", pairs_per_task=4)
        placed = spread.withColumn("task", F.spark_partition_id())
        tasks = placed.groupBy("k").agg(
            F.count(F.lit(1)).alias("pairs"), F.countDistinct("task").alias("tasks")
        )
        rows = {row.k: row for row in tasks.collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(row.pairs for row in rows.values()) == 12_000 * 12 + 3 * 1_000_000
    assert all(rows[k].tasks > 1 for k in (-3, -2, -1))


def test_one_sided_keys(spark):
    left = spark.range(2000).select(F.lit("a").alias("k"), "id")
    right = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, n int")
    assert many_to_many(left, right, "k", pairs_per_task=50).count() == 2000
    assert many_to_many(left.limit(0), right, "k").count() == 0


def test_rows_are_dealt_out_alike_each_time(spark, tmp_path, sides):
    stored = []
    for name, side in zip(("left", "right"), sides, strict=True):
        numbered = side.withColumn(f"{name}_row", F.monotonically_increasing_id())
        numbered.write.parquet(str(tmp_path / name))
        stored.append(spark.read.parquet(str(tmp_path / name)))

    def dealt():
        pairs = many_to_many(*stored, "courier_id", pairs_per_task=5_000)
        tasks = pairs.withColumn("task", F.spark_partition_id())
        tasks = tasks.withColumn("placed", F.xxhash64("left_row", "right_row", "task"))
        return tasks.agg(F.sum(F.col("placed").cast("decimal(38,0)"))).first()

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert dealt() == dealt()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_heavy_key_is_dealt_out_over_tasks(spark, sides):
    left, right = sides
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spread = many_to_many(left, right, "courier_id", pairs_per_task=5_000)
        plain = left.hint("merge").join(right, "courier_id")
        largest = [
            df.groupBy(F.spark_partition_id().alias("task")).count().agg(F.max("count")).first()[0]
            for df in (spread, plain)
        ]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert largest[1] >= 500_000
    assert largest[0] < largest[1] / 2


@pytest.fixture
def item_sides(spark):
    """One item has a third of all orders; some items have two stock rows."""
    item = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).cast("int")
    orders = spark.range(6000).select(
        F.col("id").alias("order_id"),
        item.alias("item_id"),
        (F.col("id") % 100).cast("decimal(10,2)").alias("total_order_value"),
        F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") % 20).cast("int")).alias(
            "order_date"
        ),
    )
    inventory = spark.range(40).select(
        F.col("id").cast("int").alias("item_id"),
        F.concat(F.lit("item "), "id").alias("name"),
        F.concat(F.lit("w"), (F.col("id") % 4).cast("string")).alias("warehouse"),
        F.lit("In stock").alias("stock_flag"),
    )
    inventory = inventory.unionByName(
        inventory.filter("item_id in (1, 7)").withColumn("name", F.lit("second"))
    )
    return orders, inventory


def test_figures_with_and_without_the_fact_agree(item_sides):
    orders, inventory = item_sides
    fact = orders_fact(orders, inventory)
    for stored, direct in (
        (kpis.fact_count, kpis.fact_count_of),
        (kpis.daily_orders, kpis.daily_orders_of),
        (kpis.avg_cart_value, kpis.avg_cart_value_of),
        (kpis.volume_by_warehouse_item, kpis.volume_by_warehouse_item_of),
    ):
        expected, actual = stored(fact), direct(orders, inventory)
        assert actual.columns == expected.columns
        assert sorted(map(repr, actual.collect())) == sorted(map(repr, expected.collect()))


@pytest.mark.parametrize("pairs_per_task", [10, 500])
def test_item_heavy_on_both_sides(item_sides, pairs_per_task):
    orders, inventory = item_sides
    stock = inventory.unionByName(
        inventory.filter("item_id = 1").withColumn("name", F.explode(F.array_repeat("name", 30)))
    )
    orders = orders.withColumn("item_id", F.when(F.col("order_id") % 7 > 0, F.col("item_id")))
    spread = with_stock(orders, stock, pairs_per_task, wide_from=10)
    assert tally(spread) == tally(orders.join(stock, "item_id", "left"))


def test_heavy_item_is_split_at_run_time(spark, item_sides):
    orders, inventory = item_sides
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    }
    expected = tally(orders_fact(orders, inventory))
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        fact = orders_fact(orders, inventory)
        rows = fact.collect()
        plan = fact._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert "SortMergeJoin(skew=true)" in plan
    assert tally(spark.createDataFrame(rows, fact.schema)) == expected
