"""Time the main queries and jobs; prints one JSON line.

Each entry runs twice to warm up and then ``BENCH_RUNS`` times; its figure is the
median. Query results are computed in full and discarded; jobs write tables.
"""

from __future__ import annotations

import json
import os
import statistics
import time
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from larderline.plans import jobs
from larderline.plans.warehouse import Warehouse
from larderline.workspace import build_session, new_run_folder
from larder_checks import inputs
from larder_checks.queries import QUERIES

QUERY_NAMES = [
    "orders_null_rows",
    "orders_dim",
    "inventory_dim",
    "orders_fact",
    "fact_count",
    "daily_orders_top10",
    "avg_cart_value",
    "volume_by_warehouse_item",
    "stock_alert_counts",
    "gps_clean",
    "status_clean",
    "courier_tracking",
    "courier_tracking_within",
    "csv_orders_ingest",
    "stream_gps_clean",
    "stream_courier_tracking",
    "stream_status_counts",
]


def _warehouse(spark: SparkSession) -> Warehouse:
    root = new_run_folder(spark, "bench")
    return Warehouse(spark, f"bench_{uuid.uuid4().hex[:12]}", root).create()


def dimension_job(spark: SparkSession, folder: str) -> None:
    warehouse = _warehouse(spark)
    jobs.load_dimensions(
        warehouse, inputs.orders_raw(spark, folder), inputs.inventory_raw(spark, folder)
    )
    jobs.stock_report(warehouse).collect()


def event_job(spark: SparkSession, folder: str) -> None:
    jobs.load_event_dimensions(
        _warehouse(spark), inputs.gps_raw(spark, folder), inputs.status_raw(spark, folder)
    )


def _query(name: str) -> Callable[[SparkSession, str], None]:
    def run(spark: SparkSession, folder: str) -> None:
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()

    return run


def _median_seconds(run: Callable[[], None], runs: int) -> float:
    for _ in range(2):
        run()
    seconds = []
    for _ in range(runs):
        start = time.perf_counter()
        run()
        seconds.append(time.perf_counter() - start)
    return statistics.median(seconds)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = os.environ.get("BENCH_ONLY", "")
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    timed = {name: _query(name) for name in QUERY_NAMES}
    timed |= {"dimension_job": dimension_job, "event_job": event_job}
    if only:
        timed = {name: timed[name] for name in only.split(",")}
    queries = {
        name: round(_median_seconds(lambda run=run: run(spark, folder), runs), 3)
        for name, run in timed.items()
    }
    result = {
        "metric": "total_seconds",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
