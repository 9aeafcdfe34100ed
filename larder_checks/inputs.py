"""Turn the test tables into source-shaped inputs with realistic faults.

The test tables hold no NULLs and no copies, so faults are planted by rule over
whole tables. ``sql.py`` states the same rules for the checking engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larderline.functions.text import courier_id


# The columns that are used of each test table.
COLUMNS = {
    "lineitem": "l_orderkey long, l_partkey long, l_quantity double, l_extendedprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int",
    "events": "event_id long, user_id long, event_type string",
}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{folder}/{name}.parquet")


def _every(key: str, step: int) -> Column:
    return F.col(key) % step == 0


def _null_every(key: str, step: int, value: Column) -> Column:
    return F.when(~_every(key, step), value)


def _order_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem")
    heads = read_table(spark, folder, "orders")
    return lines.join(heads, lines.l_orderkey == heads.o_orderkey)


def orders_source(spark: SparkSession, folder: str) -> DataFrame:
    """Order rows without faults: one per order line."""
    return _order_lines(spark, folder).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").cast("int").alias("item_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("price"),
        F.col("o_orderdate").alias("order_ts"),
        F.col("o_orderstatus").alias("status"),
    )


def _messy_status() -> Column:
    order_status = F.col("o_orderstatus")
    finished = order_status == "F"
    return (
        F.when(_every("l_orderkey", 107), F.lit(None))
        .when(_every("l_orderkey", 53), " Test ")
        .when(order_status == "P", " Pending ")
        .when((order_status == "O") & _every("l_orderkey", 2), "Processing")
        .when(order_status == "O", "SHIPPING")
        .when(finished & _every("l_orderkey", 3), "Canceled by user")
        .when(finished & _every("l_orderkey", 5), "Returned")
        .when((F.col("copy") == 1) & _every("l_orderkey", 74), "Deliv.")
        .otherwise(" Delivered")
    )


def orders_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Order rows with NULLs, test orders, unknown items, mixed spelling and
    copies; some copies are equal only after statuses are grouped."""
    copies = F.when(_every("l_orderkey", 37), F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    item = F.when(_every("l_orderkey", 97), -1 - F.col("l_partkey")).otherwise(
        F.col("l_partkey")
    )
    key = "l_orderkey"
    # Values beyond ten digits.
    own_price = F.col("l_extendedprice").cast("string")
    price = F.when(_every(key, 113), F.lit("99999999.99")).otherwise(own_price)
    return (
        _order_lines(spark, folder)
        .withColumn("copy", F.explode(copies))
        .select(
            F.col(key).alias("order_id"),
            _null_every(key, 101, F.col("o_custkey")).alias("user_id"),
            item.cast("int").alias("item_id"),
            _null_every(key, 103, F.col("l_quantity").cast("int")).alias("quantity"),
            _null_every(key, 109, price.cast("decimal(10,2)")).alias("price"),
            F.col("o_orderdate").alias("order_ts"),
            _messy_status().alias("status"),
        )
    )


def orders_text(spark: SparkSession, folder: str) -> DataFrame:
    """Faultless orders as the text of a CSV export, with ISO times."""
    rows = orders_source(spark, folder)
    moment = F.date_format("order_ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return rows.select(
        *[
            (moment if name == "order_ts" else F.col(name).cast("string")).alias(name)
            for name in rows.columns
        ]
    )


def with_odd_texts(rows: DataFrame, column: str, key: str) -> DataFrame:
    """The rows with blanks, quotes, separators, line breaks and empty texts in a
    text column, by a whole number in another."""
    value, number = F.col(column), F.col(key).cast("bigint")
    odd = (
        F.when(number % 7 == 0, F.concat(F.lit("  "), value, F.lit(" ")))
        .when(number % 7 == 1, F.concat(F.lit('the "'), value, F.lit('" one')))
        .when(number % 7 == 2, F.lit(""))
        .when(number % 7 == 3, F.concat(value, F.lit(",\n"), value))
        # Behind the line break stands what looks like an order.
        .when(number % 7 == 4, F.concat(value, F.lit("\n9,9,9,9,9.00,2025-01-01T00:00:00Z,x")))
        .otherwise(value)
    )
    return rows.withColumn(column, odd)


def orders_text_with_faults(spark: SparkSession, folder: str) -> DataFrame:
    """The same export with unreadable numbers, prices and times."""
    text = orders_text(spark, folder)
    key = F.col("order_id").cast("bigint")

    def broken(name: str, step: int, value: str) -> Column:
        return F.when(key % step == 0, F.lit(value)).otherwise(F.col(name))

    return text.withColumns(
        {
            "quantity": broken("quantity", 41, "many"),
            "price": broken("price", 43, "n/a"),
            "order_ts": broken("order_ts", 47, "yesterday"),
        }
    )


def inventory_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Inventory documents as text, with NULLs, levels that are no number,
    negative levels, copies in other spelling, and second rows of an item."""
    parts = read_table(spark, folder, "part")
    key = "p_partkey"
    name = F.when(_every(key, 2), F.upper("p_name")).otherwise(
        F.concat(F.lit(" "), F.col("p_name"), F.lit(" "))
    )
    names = F.array_compact(
        F.array(
            name,
            F.when(_every(key, 31), F.upper(name)),
            F.when(_every(key, 89), F.concat(F.trim(name), F.lit(" XL"))),
        )
    )
    level = (
        F.when(_every(key, 43), F.lit(None))
        .when(_every(key, 41), "n/a")
        .when(_every(key, 23), "0")
        .otherwise((F.col("p_size") - 3).cast("string"))
    )
    return parts.withColumn("listed_name", F.explode(names)).select(
        F.col(key).cast("string").alias("item_id"),
        F.col("listed_name").alias("name"),
        _null_every(key, 67, F.col("p_type")).alias("category"),
        _null_every(key, 71, F.col("p_brand")).alias("Warehouse"),
        level.alias("stock_level"),
        F.lit("2025-07-01 08:00:00").alias("last_update"),
    )


def _event_seconds() -> Column:
    return F.lit(1704067200) + F.col("event_id") * 259


def gps_raw(spark: SparkSession, folder: str) -> DataFrame:
    """A position per event as text, some without a usable latitude."""
    latitude = (
        F.when(_every("event_id", 61), "bad")
        .when(_every("event_id", 59), F.lit(None))
        .otherwise((F.col("event_id") % 180 - 90).cast("string"))
    )
    return read_table(spark, folder, "events").select(
        courier_id(F.col("user_id")).alias("courier_id"),
        latitude.alias("lat"),
        (F.col("event_id") % 360 - 180).cast("string").alias("lon"),
        # Milliseconds, which lie outside the calendar if read as seconds.
        F.when(_every("event_id", 173), _event_seconds() * 1000)
        .otherwise(_event_seconds())
        .cast("string")
        .alias("ts"),
    )


def status_raw(spark: SparkSession, folder: str) -> DataFrame:
    """An order status per event as text, some with a malformed order id."""
    order = F.when(_every("event_id", 67), "x").otherwise(
        (F.col("event_id") % 1000).cast("string")
    )
    return read_table(spark, folder, "events").select(
        order.alias("order_id"),
        courier_id(F.col("user_id")).alias("courier_id"),
        F.upper("event_type").alias("status"),
        _event_seconds().cast("string").alias("ts"),
    )


def status_redelivered(spark: SparkSession, folder: str) -> DataFrame:
    """Status events of which some arrive twice."""
    repeated = F.col("ts").cast("bigint") % 37 == 0
    copies = F.when(repeated, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return status_raw(spark, folder).withColumn("copy", F.explode(copies)).drop("copy")
