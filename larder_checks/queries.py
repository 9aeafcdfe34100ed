"""The registered queries: name to function of session and table folder."""

from __future__ import annotations

import contextlib
import datetime as dt
import uuid
from collections.abc import Callable, Collection, Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from larderline.functions.labels import order_status, order_value, stock_flag
from larderline.operators import conform, inspection, loading, nulls
from larderline.plans import dims, facts, jobs, kpis
from larderline.plans.warehouse import Warehouse
from larderline.sinks import files as file_sinks
from larderline.sinks import tables as table_sinks
from larderline.sinks import topics as topic_sinks
from larderline.sources import files, topics
from larderline.schemas import INVENTORY_DOCUMENT
from larderline.streaming import events, late, sinks
from larderline.workspace import SPLIT_BYTES, new_run_folder, prepare, remembered, stored_bytes
from larder_checks import inputs

Query = Callable[[SparkSession, str], DataFrame]

# Positions and status events at most this far apart belong together in the
# stream, where the batch fact has no bound.
TRACKING_SECONDS = 43_200
LATE_BY = "1 day"
LATE_SECONDS = 86_400
# Batches that the events of a stream with state come in.
DELIVERIES = 3
# Splits that small files are cut into, and documents in a file that is an array.
SPLITS = 8
DOCUMENTS_IN_ARRAY = 5_000
# Messages in a file of a delivery.
ROWS_IN_FILE = 200_000

QUERIES: dict[str, Query] = {}


def registered(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def _orders_raw(spark: SparkSession, folder: str) -> DataFrame:
    """The orders; the session is made ready for them, as the jobs do it."""
    orders = inputs.orders_raw(spark, folder)
    prepare(spark, orders)
    return orders


def _orders_complete(spark: SparkSession, folder: str) -> DataFrame:
    return nulls.drop_null_rows(_orders_raw(spark, folder))


def _orders_standard(spark: SparkSession, folder: str) -> DataFrame:
    return conform.standardize(_orders_complete(spark, folder), "status")


def _inventory_typed(spark: SparkSession, folder: str) -> DataFrame:
    complete = nulls.drop_null_rows(inputs.inventory_raw(spark, folder))
    return conform.cast_inventory(complete)


def _inventory_standard(spark: SparkSession, folder: str) -> DataFrame:
    typed = _inventory_typed(spark, folder)
    return conform.standardize(typed, "name", "category", "warehouse")


# Missing values


@registered
def orders_null_rows(spark: SparkSession, folder: str) -> DataFrame:
    return nulls.null_rows(inputs.orders_raw(spark, folder))


@registered
def inventory_null_rows(spark: SparkSession, folder: str) -> DataFrame:
    return nulls.null_rows(inputs.inventory_raw(spark, folder))


@registered
def orders_dropna(spark: SparkSession, folder: str) -> DataFrame:
    return _orders_complete(spark, folder)


@registered
def inventory_dropna(spark: SparkSession, folder: str) -> DataFrame:
    return nulls.drop_null_rows(inputs.inventory_raw(spark, folder))


@registered
def orders_fillna(spark: SparkSession, folder: str) -> DataFrame:
    return nulls.fill_defaults(inputs.orders_raw(spark, folder), nulls.ORDER_DEFAULTS)


@registered
def inventory_fillna(spark: SparkSession, folder: str) -> DataFrame:
    return nulls.fill_defaults(inputs.inventory_raw(spark, folder), nulls.INVENTORY_DEFAULTS)


# Columns


@registered
def inventory_select(spark: SparkSession, folder: str) -> DataFrame:
    stored = inputs.inventory_raw(spark, folder).withColumn("_id", F.xxhash64("item_id", "name"))
    return conform.inventory_columns(stored)


@registered
def inventory_cast(spark: SparkSession, folder: str) -> DataFrame:
    return _inventory_typed(spark, folder)


@registered
def orders_standardize(spark: SparkSession, folder: str) -> DataFrame:
    return _orders_standard(spark, folder)


@registered
def inventory_standardize(spark: SparkSession, folder: str) -> DataFrame:
    return _inventory_standard(spark, folder)


@registered
def snake_case_columns(spark: SparkSession, folder: str) -> DataFrame:
    spaced = inputs.orders_raw(spark, folder).select(
        F.col("order_id").alias("Order ID"),
        F.col("order_ts").alias("orderTs"),
        F.col("status").alias("Order Status"),
    )
    return conform.snake_case_columns(spaced)


@registered
def orders_total_value(spark: SparkSession, folder: str) -> DataFrame:
    value = order_value(F.col("quantity"), F.col("price"))
    return _orders_complete(spark, folder).select(
        "order_id", "quantity", "price", value.alias("total_order_value")
    )


@registered
def orders_status_norm(spark: SparkSession, folder: str) -> DataFrame:
    return _orders_standard(spark, folder).select(
        "order_id",
        F.col("status").alias("raw_status"),
        order_status(F.col("status")).alias("status"),
    )


@registered
def orders_order_date(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.orders_raw(spark, folder).select(
        "order_id", "order_ts", F.to_date("order_ts").alias("order_date")
    )


@registered
def inventory_stock_flag(spark: SparkSession, folder: str) -> DataFrame:
    return _inventory_typed(spark, folder).select(
        "item_id", "stock_level", stock_flag(F.col("stock_level")).alias("stock_flag")
    )


# Rows


@registered
def orders_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return conform.distinct_rows(_orders_standard(spark, folder))


@registered
def inventory_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return conform.distinct_rows(_inventory_standard(spark, folder))


@registered
def orders_drop_test(spark: SparkSession, folder: str) -> DataFrame:
    return conform.drop_test_orders(_orders_standard(spark, folder))


# Dimensions and facts


@registered
def orders_dim(spark: SparkSession, folder: str) -> DataFrame:
    return dims.orders_dim(_orders_raw(spark, folder))


@registered
def orders_dim_filled(spark: SparkSession, folder: str) -> DataFrame:
    return dims.orders_dim(_orders_raw(spark, folder), null_policy="fill")


@registered
def inventory_dim(spark: SparkSession, folder: str) -> DataFrame:
    return dims.inventory_dim(inputs.inventory_raw(spark, folder))


@registered
def gps_clean(spark: SparkSession, folder: str) -> DataFrame:
    return dims.gps_dim(inputs.gps_raw(spark, folder))


@registered
def status_clean(spark: SparkSession, folder: str) -> DataFrame:
    return dims.status_dim(inputs.status_raw(spark, folder))


@registered
def orders_fact(spark: SparkSession, folder: str) -> DataFrame:
    return facts.orders_fact(orders_dim(spark, folder), inventory_dim(spark, folder))


@registered
def courier_tracking(spark: SparkSession, folder: str) -> DataFrame:
    return facts.courier_tracking(gps_clean(spark, folder), status_clean(spark, folder))


@registered
def courier_tracking_within(spark: SparkSession, folder: str) -> DataFrame:
    return facts.courier_tracking_within(
        gps_clean(spark, folder), status_clean(spark, folder), TRACKING_SECONDS
    )


# Figures


@registered
def fact_count(spark: SparkSession, folder: str) -> DataFrame:
    return kpis.fact_count_of(orders_dim(spark, folder), inventory_dim(spark, folder))


@registered
def daily_orders_top10(spark: SparkSession, folder: str) -> DataFrame:
    return kpis.daily_orders_of(orders_dim(spark, folder), inventory_dim(spark, folder))


@registered
def avg_cart_value(spark: SparkSession, folder: str) -> DataFrame:
    return kpis.avg_cart_value_of(orders_dim(spark, folder), inventory_dim(spark, folder))


@registered
def volume_by_warehouse_item(spark: SparkSession, folder: str) -> DataFrame:
    return kpis.volume_by_warehouse_item_of(
        orders_dim(spark, folder), inventory_dim(spark, folder)
    )


@registered
def stock_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return kpis.stock_alerts(inventory_dim(spark, folder))


@registered
def stock_alert_counts(spark: SparkSession, folder: str) -> DataFrame:
    return kpis.stock_alert_counts(inventory_dim(spark, folder))


@registered
def quality_counts(spark: SparkSession, folder: str) -> DataFrame:
    return kpis.quality_counts(
        orders_dim=orders_dim(spark, folder),
        inventory_dim=inventory_dim(spark, folder),
        gps_dim=gps_clean(spark, folder),
        status_dim=status_clean(spark, folder),
    )


@registered
def source_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    return inspection.row_counts(
        orders=inputs.orders_raw(spark, folder), inventory=inputs.inventory_raw(spark, folder)
    )


# Inspection


@registered
def describe_orders(spark: SparkSession, folder: str) -> DataFrame:
    return inspection.describe_columns(inputs.orders_raw(spark, folder))


@registered
def schema_is_flat(spark: SparkSession, folder: str) -> DataFrame:
    documents = inspection.require_flat(inputs.inventory_raw(spark, folder))
    return inspection.describe_columns(documents).select("column_name", "is_nested", "null_rows")


@registered
def orders_sample(spark: SparkSession, folder: str) -> DataFrame:
    return inspection.sample(inputs.orders_raw(spark, folder))


@registered
def orders_sample_check(spark: SparkSession, folder: str) -> DataFrame:
    """How many rows the sample has, and how many of them are no orders."""
    orders = inputs.orders_raw(spark, folder)
    sampled = inspection.sample(orders)
    return inspection.row_counts(sample=sampled, no_orders=sampled.exceptAll(orders))


# Loading and round trips


@contextlib.contextmanager
def _cut_files(spark: SparkSession, path: str) -> Iterator[None]:
    """Splits as small as it takes to cut a folder of small files into several."""
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    small = max(stored_bytes(spark, path) // SPLITS, 1)
    if small < SPLIT_BYTES:
        spark.conf.set(setting, str(small))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def _orders_csv(spark: SparkSession, rows: DataFrame, purpose: str) -> DataFrame:
    path = f"{new_run_folder(spark, purpose)}/orders"
    file_sinks.append_csv(rows, path)
    with _cut_files(spark, path):
        return files.read_orders_csv(spark, path)


@registered
def csv_orders_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Texts with line breaks, in files that are cut anywhere."""
    odd = inputs.with_odd_texts(inputs.orders_text(spark, folder), "status", "order_id")
    return loading.all_orders_or_fail(_orders_csv(spark, odd, "csv_orders_ingest"))


@registered
def orders_accepted(spark: SparkSession, folder: str) -> DataFrame:
    faulty = inputs.orders_text_with_faults(spark, folder)
    return loading.accepted_orders(_orders_csv(spark, faulty, "orders_accepted"))


@registered
def orders_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    faulty = inputs.orders_text_with_faults(spark, folder)
    return loading.rejected_orders(_orders_csv(spark, faulty, "orders_quarantine"))


def _loaded_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Keys of finished orders, taken as loaded by an earlier run."""
    heads = inputs.read_table(spark, folder, "orders")
    return heads.filter(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").alias("order_id")
    )


@registered
def orders_load_new_keys(spark: SparkSession, folder: str) -> DataFrame:
    incoming = inputs.orders_source(spark, folder)
    return loading.new_rows(incoming, _loaded_orders(spark, folder), "order_id")


@registered
def orders_load_conflicts(spark: SparkSession, folder: str) -> DataFrame:
    incoming = inputs.orders_source(spark, folder)
    return loading.key_conflicts(incoming, _loaded_orders(spark, folder), "order_id")


def _new_warehouse(
    spark: SparkSession, purpose: str, by_day: Collection[str] = ()
) -> Warehouse:
    root = new_run_folder(spark, purpose)
    return Warehouse(spark, f"larder_{uuid.uuid4().hex[:12]}", root, by_day).create()


@registered
def orders_table_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = _new_warehouse(spark, "orders_table_roundtrip").create()
    warehouse.append("orders", inputs.orders_source(spark, folder))
    return warehouse.table("orders")


@registered
def json_inventory_ingest(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{new_run_folder(spark, 'json_inventory_ingest')}/inventory"
    file_sinks.write_documents(inputs.inventory_raw(spark, folder), path)
    return files.read_inventory_json(spark, path, layout="lines")


@registered
def json_inventory_whole(spark: SparkSession, folder: str) -> DataFrame:
    """Files that are an array each, without line breaks, and are cut anywhere."""
    path = f"{new_run_folder(spark, 'json_inventory_whole')}/inventory"
    rows = inputs.inventory_raw(spark, folder)
    arrays = max(rows.count() // DOCUMENTS_IN_ARRAY, 1)
    dealt = rows.withColumn("file", F.pmod(F.xxhash64(*rows.columns), F.lit(arrays)))
    in_file = Window.partitionBy("file").orderBy(*rows.columns)
    first = F.row_number().over(in_file) == 1
    last = F.lead(F.lit(1)).over(in_file).isNull()
    document = F.to_json(F.struct(*INVENTORY_DOCUMENT.names))
    value = F.concat(
        F.when(first, "[").otherwise(""), document, F.when(last, "]").otherwise(",")
    )
    # One blank follows each document, and no line ends.
    content = dealt.select("file", value.alias("value"))
    content.write.partitionBy("file").option("lineSep", " ").text(path)
    with _cut_files(spark, path):
        return files.read_inventory_json(spark, path, layout="whole")


@registered
def json_inventory_array(spark: SparkSession, folder: str) -> DataFrame:
    """Arrays by lines, of which some hold several documents."""
    path = f"{new_run_folder(spark, 'json_inventory_array')}/inventory"
    document = F.to_json(F.struct(*INVENTORY_DOCUMENT.names))
    lines = (
        inputs.inventory_raw(spark, folder)
        .groupBy("item_id")
        .agg(F.array_join(F.collect_list(document), ", ").alias("documents"))
    )
    lines.select(F.concat("documents", F.lit(",")).alias("value")).write.text(path)
    return files.read_inventory_json(spark, path, layout="array_lines")


def _odd_events(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    gps = inputs.with_odd_texts(inputs.gps_raw(spark, folder), "courier_id", "ts")
    status = inputs.with_odd_texts(inputs.status_raw(spark, folder), "status", "ts")
    return gps, status


@registered
def csv_events_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    root = new_run_folder(spark, "csv_events_roundtrip")
    gps, status = _odd_events(spark, folder)
    file_sinks.append_csv(gps, f"{root}/gps")
    file_sinks.append_csv(status, f"{root}/status")
    with _cut_files(spark, f"{root}/gps"):
        gps = files.read_gps_csv(spark, f"{root}/gps")
    with _cut_files(spark, f"{root}/status"):
        status = files.read_status_csv(spark, f"{root}/status")
    return gps.withColumn("feed", F.lit("gps")).unionByName(
        status.withColumn("feed", F.lit("status")), allowMissingColumns=True
    )


@registered
def csv_event_dimensions(spark: SparkSession, folder: str) -> DataFrame:
    """The event job from CSV files to the tables it writes."""
    warehouse = _new_warehouse(spark, "csv_event_dimensions")
    root = new_run_folder(spark, "csv_event_dimensions")
    file_sinks.append_csv(inputs.gps_raw(spark, folder), f"{root}/gps")
    file_sinks.append_csv(inputs.status_raw(spark, folder), f"{root}/status")
    jobs.load_event_dimensions(
        warehouse,
        files.read_gps_csv(spark, f"{root}/gps"),
        files.read_status_csv(spark, f"{root}/status"),
    )
    gps, status = warehouse.table("gps_dim"), warehouse.table("status_dim")
    return gps.unionByName(status, allowMissingColumns=True)


@registered
def events_to_json(spark: SparkSession, folder: str) -> DataFrame:
    return topic_sinks.as_messages(inputs.gps_raw(spark, folder))


@registered
def sink_overwrite_idempotent(spark: SparkSession, folder: str) -> DataFrame:
    """Both dimensions after two loads, by content."""
    warehouse = _new_warehouse(spark, "sink_overwrite_idempotent")
    for _ in range(2):
        jobs.load_dimensions(
            warehouse, inputs.orders_raw(spark, folder), inputs.inventory_raw(spark, folder)
        )
    orders, inventory = warehouse.table("orders_dim"), warehouse.table("inventory_dim")
    return orders.unionByName(inventory, allowMissingColumns=True)


@registered
def orders_load_job(spark: SparkSession, folder: str) -> DataFrame:
    """CSV to the orders table: a first load, one that is refused for a taken
    key, one that is refused for a bad row, and one that skips what is loaded."""
    warehouse = _new_warehouse(spark, "orders_load_job")
    once = inputs.orders_text(spark, folder).dropDuplicates(["order_id"])
    keyed = once.withColumn("status", F.lit("new")).withColumn("quantity", F.lit("1"))
    keyed = keyed.select(
        "order_id", "user_id", F.col("order_id").alias("item_id"), "quantity",
        F.lit("2.50").alias("price"), "order_ts", "status",
    )
    even = F.col("order_id").cast("bigint") % 2 == 0
    first = _orders_csv(spark, keyed.filter(even), "orders_load_job")
    everything = _orders_csv(spark, keyed, "orders_load_job")
    broken = keyed.filter(~even).withColumn("price", F.lit("n/a"))
    faulty = _orders_csv(spark, broken, "orders_load_job")
    jobs.load_orders(warehouse, first)
    for refused in (everything, faulty):
        try:
            jobs.load_orders(warehouse, refused)
        except Exception as error:  # noqa: BLE001
            if "nothing was loaded" not in str(error) and "bad price" not in str(error):
                raise
        else:
            raise AssertionError("a load that should be refused was not")
    jobs.load_orders(warehouse, everything, skip_loaded=True)
    return warehouse.table("orders")


@registered
def load_counts(spark: SparkSession, folder: str) -> DataFrame:
    """What a load of the dimensions says it has read and written."""
    counts = jobs.load_dimensions(
        _new_warehouse(spark, "load_counts"),
        inputs.orders_raw(spark, folder),
        inputs.inventory_raw(spark, folder),
    )
    rows = [(table, name, n) for table, found in counts.items() for name, n in found.items()]
    return spark.createDataFrame(rows, "table_name string, counted string, n long")


@registered
def describe_table(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = _loaded_warehouse(spark, folder, "describe_table")
    described = warehouse.describe("orders_dim").select("col_name", "data_type")
    counts = inspection.describe_columns(warehouse.table("orders_dim"))
    named = counts.select(F.col("column_name").alias("col_name"), "null_rows")
    return described.join(named, "col_name")


@registered
def table_statistics(spark: SparkSession, folder: str) -> DataFrame:
    """What the catalog knows of the dimensions' columns after a load."""
    warehouse = _new_warehouse(spark, "table_statistics")
    jobs.load_dimensions(
        warehouse,
        inputs.orders_raw(spark, folder),
        inputs.inventory_raw(spark, folder),
        analyze=True,
    )
    rows = []
    for table, columns in jobs.JOINED_COLUMNS.items():
        for column in columns:
            known = warehouse.statistics(table, column)
            rows.append((table, column, known["min"], known["max"], int(known["num_nulls"])))
    return spark.createDataFrame(
        rows, "table_name string, column_name string, least string, greatest string, null_rows long"
    )


@registered
def sink_partitioned_by_warehouse(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{new_run_folder(spark, 'sink_partitioned_by_warehouse')}/orders_fact"
    # Names that are empty, or look like a number.
    named = F.when(F.col("item_id") % 5 == 0, "").when(F.col("item_id") % 5 == 1, "007")
    rows = orders_fact(spark, folder)
    rows = rows.withColumn("warehouse", F.coalesce(named, F.col("warehouse")))
    table_sinks.write_clustered(rows, path, cluster_by="warehouse")
    return table_sinks.read_clustered(spark, path)


@registered
def sink_run_append(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{new_run_folder(spark, 'sink_run_append')}/orders_fact"
    rows = orders_fact(spark, folder)
    for run_id in ("001", "002", "002"):
        table_sinks.append_run(rows, path, run_id)
    return table_sinks.read_runs(spark, path)


def _loaded_warehouse(
    spark: SparkSession, folder: str, purpose: str, by_day: Collection[str] = ()
) -> Warehouse:
    warehouse = _new_warehouse(spark, purpose, by_day)
    jobs.load_dimensions(
        warehouse, inputs.orders_raw(spark, folder), inputs.inventory_raw(spark, folder)
    )
    return warehouse


@registered
def fact_append_twice(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = _loaded_warehouse(spark, folder, "fact_append_twice")
    for _ in range(2):
        warehouse.append("orders_fact", warehouse.build_orders_fact())
    return kpis.fact_summary(warehouse.table("orders_fact"))


@registered
def fact_replace_days(spark: SparkSession, folder: str) -> DataFrame:
    """A fact kept by day, of which some days are loaded twice over, some are
    missing, and one should not be there. Those days are replaced, twice."""
    warehouse = _loaded_warehouse(spark, folder, "fact_replace_days", by_day=["orders_fact"])
    fact = warehouse.build_orders_fact()
    day = F.col("order_date")
    number = F.date_diff(day, F.lit("1970-01-01")) % 97
    copies = F.when(number == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    doubled = fact.filter(F.coalesce(number != 2, F.lit(True))).withColumn("copy", F.explode(copies))
    stray = fact.limit(1).withColumn("order_date", F.lit("1900-01-01").cast("date"))
    warehouse.replace("orders_fact", doubled.drop("copy").unionByName(stray))
    orders = warehouse.table("orders_dim")
    wrong = orders.filter(number.isin(1, 2)).select(day).distinct().collect()
    days = [row.order_date for row in wrong] + [dt.date(1900, 1, 1)]
    for _ in range(2):
        jobs.load_fact_days(warehouse, days)
    return warehouse.table("orders_fact")


@registered
def daily_orders_by_day(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = _loaded_warehouse(spark, folder, "daily_orders_by_day", by_day=["orders_fact"])
    warehouse.replace("orders_fact", warehouse.build_orders_fact())
    return kpis.daily_orders_by_day(warehouse)


def _grown_fact(spark: SparkSession, folder: str, purpose: str) -> Warehouse:
    """A fact that came in three loads, whose totals were kept."""
    warehouse = _loaded_warehouse(spark, folder, purpose)
    fact = warehouse.build_orders_fact()
    for part in range(3):
        mine = F.pmod(F.xxhash64("order_id"), F.lit(3)) == part
        jobs.append_facts(warehouse, fact.filter(mine))
    return warehouse


@registered
def totals_summary(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = _grown_fact(spark, folder, "totals_summary")
    return kpis.summary_of_totals(warehouse.table("order_totals"))


@registered
def totals_daily_orders(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = _grown_fact(spark, folder, "totals_daily_orders")
    return kpis.daily_orders_of_totals(warehouse.table("order_totals"))


@registered
def sql_orders_fact(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = _loaded_warehouse(spark, folder, "sql_orders_fact")
    spark.sql(
        f"INSERT INTO {warehouse.name('orders_fact')} "
        "SELECT o.order_id, o.item_id, i.name, i.warehouse, o.total_order_value, "
        "o.order_date, i.stock_flag "
        f"FROM {warehouse.name('orders_dim')} o "
        f"LEFT JOIN {warehouse.name('inventory_dim')} i USING (item_id)"
    )
    return warehouse.table("orders_fact")


def _stored_fact(spark: SparkSession, folder: str, purpose: str) -> Warehouse:
    warehouse = _loaded_warehouse(spark, folder, purpose)
    warehouse.replace("orders_fact", warehouse.build_orders_fact())
    return warehouse


@registered
def sql_daily_orders(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = _stored_fact(spark, folder, "sql_daily_orders")
    return spark.sql(
        f"SELECT order_date, count(*) AS order_count FROM {warehouse.name('orders_fact')} "
        "GROUP BY order_date ORDER BY order_date DESC LIMIT 10"
    )


@registered
def stored_volume_by_warehouse_item(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = _stored_fact(spark, folder, "stored_volume_by_warehouse_item")
    return kpis.volume_by_warehouse_item(warehouse.table("orders_fact"))


@registered
def show_tables(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = _loaded_warehouse(spark, folder, "show_tables")
    warehouse.append("orders", inputs.orders_source(spark, folder))
    jobs.load_event_dimensions(
        warehouse, inputs.gps_raw(spark, folder), inputs.status_raw(spark, folder)
    )
    jobs.load_facts(warehouse, unbounded_tracking=True)
    return warehouse.tables()


@registered
def stored_tracking_within(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = _loaded_warehouse(spark, folder, "stored_tracking_within")
    jobs.load_event_dimensions(
        warehouse, inputs.gps_raw(spark, folder), inputs.status_raw(spark, folder)
    )
    jobs.load_facts(warehouse, TRACKING_SECONDS)
    return warehouse.table("courier_tracking")


# Streams


def _messages(
    spark: SparkSession, rows: DataFrame, path: str, deliveries: int
) -> DataFrame:
    """The rows as messages that arrive in several deliveries, one a batch. They
    come in order of time, but for some that come a delivery late."""
    if deliveries == 1:
        topic_sinks.publish_to_folder(rows, path)
        return topics.folder_stream(spark, path)
    second = F.col("ts").cast("bigint")
    bounds = rows.filter(second < 4_000_000_000).agg(F.min(second), F.max(second)).first()
    first, last = (bound or 0 for bound in bounds)
    number = F.floor((second - first) * deliveries / (last - first + 1))
    delivery = F.least(number + F.when(second % 50 == 0, 1).otherwise(0), F.lit(deliveries - 1))
    numbered = rows.withColumn("delivery", delivery)
    # As many files for each delivery, so that a batch is one.
    files_each = 1 + rows.count() // (deliveries * ROWS_IN_FILE)
    for at in range(deliveries):
        arriving = numbered.filter(F.col("delivery") == at).drop("delivery")
        topic_sinks.publish_to_folder(arriving.repartition(files_each), path)
    return topics.folder_stream(spark, path, files_per_batch=files_each)


def _gps_stream(
    spark: SparkSession, folder: str, root: str, deliveries: int = 1
) -> DataFrame:
    rows = inputs.gps_raw(spark, folder)
    messages = _messages(spark, rows, f"{root}/gps_topic", deliveries)
    return dims.gps_dim(topics.gps_events(messages))


def _status_stream(
    spark: SparkSession, rows: DataFrame, root: str, deliveries: int = 1
) -> DataFrame:
    messages = _messages(spark, rows, f"{root}/status_topic", deliveries)
    return dims.status_dim(topics.status_events(messages))


def _split(stream: DataFrame, moment: str, path: str) -> tuple[DataFrame, DataFrame]:
    """The stream of what comes in time, and the table of what comes late."""
    late.split_late(stream, moment, LATE_SECONDS, path, f"{path}/checkpoint").awaitTermination()
    spark = stream.sparkSession
    return late.on_time(spark, path, stream, files_per_batch=4), late.late_rows(spark, path, stream)


def _nothing_dropped(query: StreamingQuery) -> None:
    query.awaitTermination()
    if sinks.dropped_rows(query):
        raise AssertionError("rows that came in time were dropped")


@registered
def stream_gps_clean(spark: SparkSession, folder: str) -> DataFrame:
    root = new_run_folder(spark, "stream_gps_clean")
    stream = _gps_stream(spark, folder, root)
    sinks.load_batches(stream, f"{root}/gps_dim", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/gps_dim").drop("batch_id")


@registered
def stream_status_clean(spark: SparkSession, folder: str) -> DataFrame:
    root = new_run_folder(spark, "stream_status_clean")
    stream = _status_stream(spark, inputs.status_raw(spark, folder), root)
    sinks.append_to_folder(stream, f"{root}/status_dim", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/status_dim")


@registered
def stream_status_from_csv(spark: SparkSession, folder: str) -> DataFrame:
    root = new_run_folder(spark, "stream_status_from_csv")
    file_sinks.append_csv(inputs.status_raw(spark, folder), f"{root}/status")
    stream = dims.status_dim(files.stream_status_csv(spark, f"{root}/status"))
    sinks.load_batches(stream, f"{root}/status_dim", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/status_dim").drop("batch_id")


@registered
def stream_courier_tracking(spark: SparkSession, folder: str) -> DataFrame:
    root = new_run_folder(spark, "stream_courier_tracking")
    gps, status = gps_clean(spark, folder), status_clean(spark, folder)
    busy = remembered(spark, f"{root}/busy", lambda: events.busy_couriers(gps, status))
    positions = _gps_stream(spark, folder, root, DELIVERIES)
    changes = _status_stream(spark, inputs.status_raw(spark, folder), root, DELIVERIES)
    positions, late_gps = _split(positions, "gps_ts", f"{root}/gps")
    changes, late_status = _split(changes, "status_ts", f"{root}/status")
    tracked = events.track_couriers(positions, changes, TRACKING_SECONDS, LATE_BY, busy)
    _nothing_dropped(sinks.append_to_folder(tracked, f"{root}/tracking", f"{root}/checkpoint"))
    caught_up = facts.late_tracking(
        late.on_time_rows(spark, f"{root}/gps", late_gps),
        late.on_time_rows(spark, f"{root}/status", late_status),
        late_gps,
        late_status,
        TRACKING_SECONDS,
    )
    return spark.read.parquet(f"{root}/tracking").unionByName(caught_up)


@registered
def stream_status_counts(spark: SparkSession, folder: str) -> DataFrame:
    root = new_run_folder(spark, "stream_status_counts")
    stream = _status_stream(spark, inputs.status_raw(spark, folder), root)
    counts = events.status_counts(stream)
    sinks.keep_latest(counts, f"{root}/counts", f"{root}/checkpoint").awaitTermination()
    return sinks.read_latest(spark, f"{root}/counts")


@registered
def stream_dedup_watermark(spark: SparkSession, folder: str) -> DataFrame:
    root = new_run_folder(spark, "stream_dedup_watermark")
    rows = inputs.status_redelivered(spark, folder)
    stream = _status_stream(spark, rows, root, DELIVERIES)
    stream, late_status = _split(stream, "status_ts", f"{root}/status")
    once = events.without_repeats(stream, LATE_BY)
    _nothing_dropped(sinks.append_to_folder(once, f"{root}/once", f"{root}/checkpoint"))
    # A copy that came late may have come in time before.
    found = spark.read.parquet(f"{root}/once")
    return found.unionByName(late_status.distinct().exceptAll(found))
