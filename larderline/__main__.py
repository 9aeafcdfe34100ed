"""Run a job: ``python -m larderline JOB --database NAME --root FOLDER ...``."""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from larderline.plans import dims, jobs
from larderline.plans.warehouse import DAY_OF, Warehouse
from larderline.sources import files, topics
from larderline.streaming import events, late, sinks
from larderline.workspace import build_session, fit_tasks, remembered

# State of a stream is split so unless said otherwise.
STATE_PARTITIONS = 200
# Arguments that name input files.
INPUTS = ("orders_csv", "inventory_json", "gps_csv", "status_csv")


def parse(words: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="larderline", description=__doc__)
    known = parser.add_subparsers(dest="job", required=True)

    def table_job(name: str, about: str, *paths: str) -> argparse.ArgumentParser:
        command = known.add_parser(name, help=about)
        command.add_argument("--database", required=True, help="schema of the tables")
        command.add_argument("--root", required=True, help="shared folder of the tables")
        command.add_argument(
            "--by-day", nargs="*", default=[], choices=sorted(DAY_OF), help="tables kept by day"
        )
        for path in paths:
            command.add_argument(f"--{path}", required=True)
        return command

    load = table_job("load-orders", "add a CSV export to the orders table", "orders-csv")
    load.add_argument("--skip-loaded", action="store_true")
    replace = table_job("dimensions", "replace the orders and inventory dimensions")
    replace.add_argument("--inventory-json", required=True)
    replace.add_argument("--json-layout", choices=files.JSON_LAYOUTS, default="whole")
    replace.add_argument("--null-policy", choices=["drop", "fill"], default="drop")
    replace.add_argument("--orders-have-key", action="store_true")
    replace.add_argument("--analyze", action="store_true", help="gather statistics for plans")
    table_job("events", "replace the event dimensions", "gps-csv", "status-csv")
    rebuild = table_job("facts", "rebuild both facts from the dimensions")
    rebuild.add_argument("--within-seconds", type=int, default=jobs.TRACKING_SECONDS)
    rebuild.add_argument("--unbounded-tracking", action="store_true")
    days = table_job("fact-days", "rebuild some days of an orders fact kept by day")
    days.add_argument("--days", nargs="+", type=dt.date.fromisoformat, required=True)

    stream = known.add_parser("stream", help="process what is new on the event topics")
    stream.add_argument("feed", choices=["gps", "status", "tracking"])
    source = stream.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", help="broker of the topics")
    source.add_argument("--folder", help="folder with a folder of message files per topic")
    stream.add_argument("--target", required=True, help="folder of the result")
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--every", help="go on, looking for new events at this interval")
    stream.add_argument("--gps-topic", default="gps_streams")
    stream.add_argument("--status-topic", default="status_streams")
    stream.add_argument("--within-seconds", type=int, default=3600)
    stream.add_argument("--late-by", default="1 day")
    stream.add_argument("--positions", help="stored positions that show who is busy")
    stream.add_argument("--changes", help="stored status events that show who is busy")
    stream.add_argument(
        "--late", help="folder for rows behind the watermark (tracking), else beside the target"
    )
    stream.add_argument("--rows-per-batch", type=int, help="of a broker's topic")
    stream.add_argument("--files-per-batch", type=int, help="of a folder of messages")
    stream.add_argument(
        "--state-partitions",
        type=int,
        default=STATE_PARTITIONS,
        help="tasks that share the state; fixed once a checkpoint is in use",
    )
    return parser.parse_args(words)


def _messages(spark: SparkSession, args: argparse.Namespace, topic: str) -> DataFrame:
    if args.servers is not None:
        return topics.topic_stream(spark, args.servers, topic, args.rows_per_batch)
    return topics.folder_stream(spark, f"{args.folder}/{topic}", args.files_per_batch)


def _keep_unparsed(spark: SparkSession, args: argparse.Namespace) -> None:
    """Write messages that are no JSON to a folder beside the target, by topic."""
    wanted = {"gps": [args.gps_topic], "status": [args.status_topic]}
    for topic in wanted.get(args.feed, [args.gps_topic, args.status_topic]):
        rows = topics.unparsed(_messages(spark, args, topic))
        places = (f"{args.target}-unparsed/{topic}", f"{args.checkpoint}-unparsed/{topic}")
        query = sinks.append_to_folder(rows, *places, args.every)
        if args.every is None:
            query.awaitTermination()


def _feed(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    def gps() -> DataFrame:
        return dims.gps_dim(topics.gps_events(_messages(spark, args, args.gps_topic)))

    def status() -> DataFrame:
        return dims.status_dim(topics.status_events(_messages(spark, args, args.status_topic)))

    if args.feed == "gps":
        return gps()
    if args.feed == "status":
        return status()
    busy = None
    if args.positions is not None and args.changes is not None:
        stored = [spark.read.parquet(path) for path in (args.positions, args.changes)]
        list_path = f"{args.checkpoint}-busy"
        busy = remembered(spark, list_path, lambda: events.busy_couriers(*stored))
    feeds = {"gps_ts": gps(), "status_ts": status()}
    feeds = {moment: _in_time(feed, moment, args) for moment, feed in feeds.items()}
    return events.track_couriers(*feeds.values(), args.within_seconds, args.late_by, busy)


def _in_time(feed: DataFrame, moment: str, args: argparse.Namespace) -> DataFrame:
    """The feed without its late rows, which stay in a folder of their own."""
    spark, path = feed.sparkSession, f"{args.late or args.target + '-late'}/{moment}"
    bound = spark.sql(f"SELECT CAST(INTERVAL {args.late_by} AS INTERVAL SECOND)").first()[0]
    seconds = int(bound.total_seconds())
    query = late.split_late(feed, moment, seconds, path, f"{path}/checkpoint", args.every)
    if args.every is None:
        query.awaitTermination()
    return late.on_time(spark, path, feed, args.files_per_batch)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "stream":
        spark.conf.set("spark.sql.shuffle.partitions", args.state_partitions)
        _keep_unparsed(spark, args)
        feed = _feed(spark, args)
        query = sinks.append_to_folder(feed, args.target, args.checkpoint, args.every)
        query.awaitTermination()
        return
    warehouse = Warehouse(spark, args.database, args.root, args.by_day).create()
    given = (getattr(args, name, None) for name in INPUTS)
    fit_tasks(spark, args.root, *filter(None, given))
    if args.job == "load-orders":
        rows = files.read_orders_csv(spark, args.orders_csv)
        jobs.load_orders(warehouse, rows, args.skip_loaded)
    elif args.job == "dimensions":
        documents = files.read_inventory_json(spark, args.inventory_json, args.json_layout)
        orders = warehouse.table("orders")
        counts = jobs.load_dimensions(
            warehouse, orders, documents, args.null_policy, args.orders_have_key, args.analyze
        )
        print(counts)
    elif args.job == "events":
        gps = files.read_gps_csv(spark, args.gps_csv)
        status = files.read_status_csv(spark, args.status_csv)
        jobs.load_event_dimensions(warehouse, gps, status)
    elif args.job == "fact-days":
        jobs.load_fact_days(warehouse, args.days)
    else:
        jobs.load_facts(warehouse, args.within_seconds, args.unbounded_tracking)
        for row in jobs.quality_report(warehouse).collect():
            print(row.asDict())


if __name__ == "__main__":
    arguments = parse()
    session = build_session(f"larderline {arguments.job}")
    run(session, arguments)
    session.stop()
