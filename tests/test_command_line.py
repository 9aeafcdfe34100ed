"""The jobs in the order a day would run them."""

from __future__ import annotations

import json
import uuid

import pytest

from larderline.__main__ import parse, run
from larderline.plans import kpis
from larderline.plans.warehouse import Warehouse
from larderline.schemas import GPS_EVENT, STATUS_EVENT
from larderline.sinks.topics import publish_to_folder


@pytest.fixture
def exports(tmp_path):
    (tmp_path / "orders.csv").write_text(
        "order_id,user_id,item_id,quantity,price,order_ts,status\n"
        "1,10,7,2,5.25,2025-07-01T08:00:00Z, Delivered \n"
        "2,11,8,1,3.00,2025-07-02T08:00:00Z,Test\n"
        "3,12,9,4,1.50,2025-07-02T09:00:00Z,shipping\n"
    )
    document = {
        "item_id": 7,
        "name": " Ring ",
        "category": "Jewels",
        "Warehouse": "East",
        "stock_level": 5,
        "last_update": "2025-07-01T00:00:00Z",
    }
    (tmp_path / "inventory.json").write_text(json.dumps([document]))
    (tmp_path / "gps.csv").write_text("courier_id,lat,lon,ts\nC001,1,2,7\nC001,bad,2,8\n")
    (tmp_path / "status.csv").write_text("order_id,courier_id,status,ts\n1,c001,SHIPPED,9\n")
    return tmp_path


def test_a_day(spark, exports, capsys):
    tables = ["--database", f"day_{uuid.uuid4().hex[:8]}", "--root", str(exports / "tables")]

    def job(name, *words):
        run(spark, parse([name, *tables, *words]))

    job("load-orders", "--orders-csv", str(exports / "orders.csv"))
    job("dimensions", "--inventory-json", str(exports / "inventory.json"))
    events = ["--gps-csv", str(exports / "gps.csv"), "--status-csv", str(exports / "status.csv")]
    job("events", *events)
    job("facts")
    assert "'low_stock_written': 1" in capsys.readouterr().out

    warehouse = Warehouse(spark, tables[1], tables[3])
    fact = warehouse.table("orders_fact")
    volumes = [tuple(row) for row in kpis.volume_by_warehouse_item(fact).collect()]
    assert volumes == [("east", "ring", 1), (None, None, 1)]
    assert kpis.avg_cart_value(fact).first()[0] == 8.25
    tracked = warehouse.table("courier_tracking").collect()
    assert [(row.courier_id, row.order_id, row.status) for row in tracked] == [
        ("c001", 1, "shipped")
    ]


def test_stream_arguments():
    args = parse(
        ["stream", "tracking", "--servers", "b:9", "--target", "t", "--checkpoint", "c"]
    )
    assert (args.feed, args.gps_topic, args.every) == ("tracking", "gps_streams", None)


def test_tracking_stream_from_folders(spark, tmp_path):
    gps = spark.createDataFrame([("C001", 1.0, 2.0, 100), ("C001", 1.0, 2.0, 9999)], GPS_EVENT)
    status = spark.createDataFrame([("7", "c001", "NEW", 130)], STATUS_EVENT)
    publish_to_folder(gps, str(tmp_path / "topics/gps_streams"))
    publish_to_folder(status, str(tmp_path / "topics/status_streams"))
    places = ["--folder", "topics", "--target", "out", "--checkpoint", "state"]
    places = [word if word.startswith("--") else str(tmp_path / word) for word in places]
    words = ["stream", "tracking", *places, "--within-seconds", "60"]
    for _ in range(2):
        run(spark, parse(words))
    tracked = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [(row.order_id, row.status) for row in tracked] == [(7, "new")]
    assert (tmp_path / "out-late" / "gps_ts").is_dir()


def test_messages_that_are_no_json_are_kept(spark, tmp_path):
    topic = tmp_path / "topics" / "status_streams"
    topic.mkdir(parents=True)
    (topic / "1.txt").write_text('{"order_id": "7", "ts": 5}\nno json\n[1]\n{"order_id": 8\n')
    places = ["--folder", "topics", "--target", "out", "--checkpoint", "state"]
    places = [word if word.startswith("--") else str(tmp_path / word) for word in places]
    for _ in range(2):
        run(spark, parse(["stream", "status", *places]))
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [row.order_id for row in rows] == [7]
    kept = spark.read.parquet(str(tmp_path / "out-unparsed" / "status_streams")).collect()
    assert sorted(row.value for row in kept) == ["[1]", "no json", '{"order_id": 8']


def test_fact_days(spark, exports, tmp_path):
    tables = ["--database", f"day_{uuid.uuid4().hex[:8]}", "--root", str(tmp_path / "tables")]
    tables += ["--by-day", "orders_dim", "orders_fact"]

    def job(name, *words):
        run(spark, parse([name, *tables, *words]))

    job("load-orders", "--orders-csv", str(exports / "orders.csv"))
    job("dimensions", "--inventory-json", str(exports / "inventory.json"))
    job("fact-days", "--days", "2025-07-02")
    warehouse = Warehouse(spark, tables[1], tables[3], tables[5:])
    assert [row.order_id for row in warehouse.table("orders_fact").collect()] == [3]
    job("fact-days", "--days", "2025-07-01", "2025-07-02")
    assert sorted(row.order_id for row in warehouse.table("orders_fact").collect()) == [1, 3]
