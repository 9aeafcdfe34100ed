"""Files in and out, and the options of connections that need a server."""

from __future__ import annotations

import csv
import io
import json
import pathlib
import random

import pytest
from pyspark.sql import functions as F

from larderline import workspace
from larderline.operators import loading
from larderline.plans.facts import orders_fact
from larderline.schemas import GPS_EVENT, INVENTORY_DOCUMENT, ORDERS, text_only
from larderline.sinks import files as file_sinks
from larderline.sinks import tables as table_sinks
from larderline.sinks import topics as topic_sinks
from larderline.sources import databases, files, records
from larder_checks.queries import QUERIES

DOCUMENT = {
    "_id": "65f0",
    "item_id": 7,
    "name": "Ring",
    "category": "tools",
    "Warehouse": "East",
    "stock_level": "12",
    "last_update": "2025-07-01 08:00:00",
}


@pytest.mark.parametrize(
    ("content", "rows"), [([DOCUMENT, DOCUMENT, DOCUMENT], 3), (DOCUMENT, 1)]
)
def test_inventory_file_of_many_or_one(spark, tmp_path, content, rows):
    (tmp_path / "inventory.json").write_text(json.dumps(content, indent=1))
    documents = files.read_inventory_json(spark, str(tmp_path))
    assert documents.columns == INVENTORY_DOCUMENT.names
    assert [row.item_id for row in documents.collect()] == ["7"] * rows


def test_documents_per_line(spark, tmp_path):
    rows = spark.createDataFrame([("7", "Ring", None, "East", "1", "x")], INVENTORY_DOCUMENT)
    file_sinks.write_documents(rows, str(tmp_path / "docs"))
    back = files.read_inventory_json(spark, str(tmp_path / "docs"), layout="lines")
    assert back.collect() == rows.collect()


def test_array_with_a_document_per_line(spark, tmp_path):
    lines = ",\n".join(json.dumps({**DOCUMENT, "name": name}) for name in ("a]", "[b,", "c"))
    (tmp_path / "inventory.json").write_text(f"[{lines}]\n")
    documents = files.read_inventory_json(spark, str(tmp_path), layout="array_lines")
    whole = files.read_inventory_json(spark, str(tmp_path))
    assert documents.collect() == whole.collect()
    assert documents.count() == 3


@pytest.mark.parametrize("layout", ["array_lines", "whole"])
def test_no_document_of_a_line_is_lost(spark, tmp_path, layout):
    (tmp_path / "inventory.json").write_text(
        '[{"item_id": 1}, {"item_id": 2},\n{"item_id": 3, "name": "a]"}\n,{"item_id": 4}]'
    )
    documents = files.read_inventory_json(spark, str(tmp_path), layout=layout)
    assert [row.item_id for row in documents.collect()] == ["1", "2", "3", "4"]


@pytest.mark.parametrize("layout", files.JSON_LAYOUTS)
def test_fields_are_found_in_any_case(spark, tmp_path, layout):
    (tmp_path / "inventory.json").write_text('{"Item_ID": 7, "warehouse": "East", "NAME": null}')
    row = files.read_inventory_json(spark, str(tmp_path), layout).first()
    assert (row.item_id, row.Warehouse, row.name) == ("7", "East", None)


@pytest.mark.parametrize("layout", files.JSON_LAYOUTS)
def test_malformed_documents_fail_the_job(spark, tmp_path, layout):
    (tmp_path / "inventory.json").write_text('[{"item_id": 1},\n{"item_id": 2')
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_inventory_json(spark, str(tmp_path), layout).collect()


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "gps.csv").write_text("ts,speed,lon,courier_id,lat\n7,90,2,C001,1\n")
    rows = files.read_gps_csv(spark, str(tmp_path)).collect()
    assert [tuple(row) for row in rows] == [("C001", "1", "2", "7")]


def test_csv_files_with_other_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("courier_id,lat,lon,ts\nC001,1,2,7\n")
    (tmp_path / "b.csv").write_text("ts,lat,lon,courier_id\n7,1,2,C001\n")
    with pytest.raises(Exception, match="header"):
        files.read_gps_csv(spark, str(tmp_path)).collect()


def test_csv_appends_keep_one_header_per_file(spark, tmp_path):
    events = spark.createDataFrame([("C001", "1.5", None, "0")], text_only(GPS_EVENT))
    for _ in range(2):
        file_sinks.append_csv(events, str(tmp_path / "gps"))
    assert files.read_gps_csv(spark, str(tmp_path / "gps")).collect() == events.collect() * 2


ODD_TEXTS = [" C001 ", "", None, 'said "test" ok', "back\\slash", "a,b", "\ttab", "null", "x\ny"]


def test_csv_values_come_back_as_they_went(spark, tmp_path):
    rows = [(text, str(n), text, "0") for n, text in enumerate(ODD_TEXTS)]
    events = spark.createDataFrame(rows, text_only(GPS_EVENT))
    file_sinks.append_csv(events, str(tmp_path / "gps"))
    back = files.read_gps_csv(spark, str(tmp_path / "gps"))
    assert sorted(map(tuple, back.collect()), key=lambda r: r[1]) == rows


@pytest.fixture
def small_splits(spark):
    """Files are cut every few bytes."""
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "61")
    yield
    spark.conf.set(setting, before)


STATUS_HEADER = "order_id,courier_id,status,ts"
PLACED = "9,9,9,9,9.00,2025-01-01T00:00:00Z,x"


def some_csv(seed):
    """Rows of texts with all that a quoted value may hold, as a file's text."""
    draw = random.Random(seed)
    parts = ["a", "b,", '"', '""', "\n", "\r\n", " ", "é", PLACED, "\n" + PLACED]
    rows = [
        [str(n), "".join(draw.choices(parts, k=draw.randint(0, 5))), draw.choice(["x", "y z"]), "0"]
        for n in range(draw.randint(0, 60))
    ]
    text = io.StringIO()
    writer = csv.writer(text, quoting=csv.QUOTE_ALL, lineterminator=draw.choice(["\n", "\r\n"]))
    writer.writerows([STATUS_HEADER.split(","), *rows])
    return rows, text.getvalue()


def test_records_are_put_together_over_splits(spark, tmp_path, small_splits):
    wanted = []
    for seed in range(12):
        rows, text = some_csv(seed)
        wanted += rows
        (tmp_path / f"{seed}.csv").write_bytes(text.encode())
    found = files.read_status_csv(spark, str(tmp_path))
    assert records.pieces(spark, str(tmp_path), "\n").rdd.getNumPartitions() > 12
    assert sorted(map(list, found.collect())) == sorted(wanted)


def test_files_are_cut_alike_when_executors_come_or_go(spark, tmp_path, monkeypatch):
    """The first scan of the records meets two cores, the second one many."""
    rows = [f'{n},"C\n{n}",x,{n}' for n in range(400)]
    (tmp_path / "a.csv").write_text("\n".join([STATUS_HEADER, *rows, ""]))
    settings = ["spark.sql.leafNodeDefaultParallelism", "spark.sql.files.openCostInBytes"]
    before = spark.conf.get(settings[1])
    written = records._written

    def with_other_cores(found, purpose):
        stored = written(found, purpose)
        spark.conf.set(settings[0], "7")
        return stored

    monkeypatch.setattr(records, "_written", with_other_cores)
    spark.conf.set(settings[0], "2")
    spark.conf.set(settings[1], "1")
    try:
        found = files.read_status_csv(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset(settings[0])
        spark.conf.set(settings[1], before)
    assert sorted(int(row.ts) for row in found) == list(range(400))
    assert all(row.courier_id == f"C\n{row.ts}" for row in found)
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) is None


def test_a_record_is_parsed_once(spark, tmp_path):
    """However many columns are checked and typed; lines are not shuffled."""
    header = ",".join(ORDERS.names)
    line = f'1,2,3,4,5.00,2025-07-01T08:00:00Z,"said\n{PLACED}"\n'
    (tmp_path / "a.csv").write_text(f"{header}\n{line}")
    typed = loading.all_orders_or_fail(files.read_orders_csv(spark, str(tmp_path / "a.csv")))
    plan = typed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv") == 1
    lines = records.pieces(spark, str(tmp_path), "\n")
    columns = "file string, split long, size long, quotes_then long, quotes long"
    none_open = spark.createDataFrame([], columns)
    parts = records._parts_of_lines(lines, records.Shape(F.lit(0)), none_open, "\n")
    physical = parts._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in physical and "Sort" not in physical


def test_a_status_that_looks_like_an_order_is_one_order(spark, tmp_path):
    header = ",".join(ORDERS.names)
    line = f'1,2,3,4,5.00,2025-07-01T08:00:00Z,"said\n{PLACED}"\n'
    (tmp_path / "a.csv").write_text(f"{header}\n{line}")
    (tmp_path / "b.csv").write_text(f"{header}\n{line.splitlines()[0]}\n" + f"7{line[1:]}")
    with pytest.raises(records.OpenQuoteError, match="b.csv"):
        files.read_orders_csv(spark, str(tmp_path))
    (order,) = files.read_orders_csv(spark, str(tmp_path / "a.csv")).collect()
    assert order.status == f"said\n{PLACED}"


@pytest.mark.parametrize(
    "lines",
    [
        # Quotes within values that are not quoted, over two lines.
        'C1,1,2" x,7\nC2,1,2" y,7',
        # A record with too few values, and one with too many.
        '"C1\n",1,7',
        '"C1\n",1,2,7,9',
    ],
)
def test_torn_rows_fail_whatever_their_columns(spark, tmp_path, lines):
    (tmp_path / "gps.csv").write_text(f"courier_id,lat,lon,ts\n{lines}\n")
    with pytest.raises(Exception, match="torn row"):
        files.read_gps_csv(spark, str(tmp_path)).collect()


def test_files_with_and_without_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text("lat,courier_id,lon,ts\n1,C001,2,7\n\n")
    (tmp_path / "b.csv").write_text('"lat","courier_id","LON",ts\r\n1,"C\n2",2,7\r\n\r\n')
    (tmp_path / "c.csv").write_text("")
    rows = files.read_gps_csv(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, rows)) == [("C\n2", "1", "2", "7"), ("C001", "1", "2", "7")]
    (tmp_path / "d.csv").write_text('courier_id,lat,lon,ts\n"C\n3",1,2,7\n')
    with pytest.raises(Exception, match="header"):
        files.read_gps_csv(spark, str(tmp_path)).collect()


def test_json_documents_are_put_together_over_splits(spark, tmp_path, small_splits):
    draw = random.Random(4)
    parts = ["a", "{", "}", '"', "\\", "[", "]", ",", "\n", "é", "\\\"", "\t"]
    names = []
    for number in range(12):
        some = ["".join(draw.choices(parts, k=draw.randint(0, 9))) for _ in range(draw.randint(0, 30))]
        documents = [{"name": name, "category": {"of": ["}", {"x": name}]}, "item_id": 1} for name in some]
        indent = draw.choice([None, None, 1])
        content = json.dumps(documents, indent=indent, ensure_ascii=draw.random() < 0.5)
        (tmp_path / f"{number}.json").write_text(draw.choice(["", "\ufeff", " \n"]) + content)
        names += some
    (tmp_path / "one.json").write_text('{"name": "{one}"}')
    found = files.read_inventory_json(spark, str(tmp_path))
    assert records.pieces(spark, str(tmp_path), "{").rdd.getNumPartitions() > 13
    assert sorted(row.name for row in found.collect()) == sorted([*names, "{one}"])


@pytest.mark.parametrize(
    "content",
    ['[{"item_id": 1},', '[{"item_id": 1}', '{"item_id": 1', '{"item_id": 1}}', '[{"item_id": 1} x]', "[1]", '{"a": "x'],
)
def test_torn_json_fails(spark, tmp_path, content):
    (tmp_path / "a.json").write_text(content)
    with pytest.raises(Exception, match="(?i)malformed|never closed"):
        files.read_inventory_json(spark, str(tmp_path)).collect()


def test_orders_csv_is_text(spark, tmp_path):
    header = ",".join(ORDERS.names)
    (tmp_path / "orders.csv").write_text(f"{header}\n1,2,3,four,5.25,2025-07-01T08:00:00Z,new\n")
    rows = files.read_orders_csv(spark, str(tmp_path))
    assert rows.first().quantity == "four"


def test_messages_are_flat_json(spark):
    events = spark.createDataFrame([("C001", 1.5, -2.0, 7)], GPS_EVENT)
    message = topic_sinks.as_messages(events).first().value
    assert json.loads(message) == {"courier_id": "C001", "lat": 1.5, "lon": -2.0, "ts": 7}


def test_run_replaces_its_own_rows_only(spark, tmp_path):
    path = str(tmp_path / "facts")
    for run_id, rows in (("a", 3), ("b", 2), ("b", 5)):
        table_sinks.append_run(spark.range(rows), path, run_id)
    counts = spark.read.parquet(path).groupBy("run_id").count().collect()
    assert {row.run_id: row["count"] for row in counts} == {"a": 3, "b": 5}


def test_clustered_write_leaves_few_files(spark, tmp_path, tables):
    fact = orders_fact(
        QUERIES["orders_dim"](spark, tables), QUERIES["inventory_dim"](spark, tables)
    )
    scattered = fact.repartition(16)
    table_sinks.write_clustered(scattered, str(tmp_path / "fact"), cluster_by="warehouse")
    folders = list((tmp_path / "fact").glob("cluster_folder=*"))
    assert len(folders) > 10
    for folder in folders:
        assert len(list(folder.glob("*.parquet"))) == 1


def test_clustered_values_and_run_ids_stay_as_they_are(spark, tmp_path):
    rows = spark.createDataFrame(
        [("", 1), ("007", 2), (None, 3), ("none", 4), ("a/b=c", 5), ("7", 6)], "w string, n int"
    )
    path = str(tmp_path / "clustered")
    table_sinks.write_clustered(rows, path, cluster_by="w")
    back = table_sinks.read_clustered(spark, path)
    assert back.schema == rows.schema
    assert sorted(back.collect(), key=lambda r: r.n) == rows.collect()
    some = table_sinks.read_clustered(spark, path, only=["", None])
    assert sorted(row.n for row in some.collect()) == [1, 3]
    assert "PartitionFilters: [cluster_folder" in some._jdf.queryExecution().toString()
    runs = str(tmp_path / "runs")
    for run_id in ("007", "08"):
        table_sinks.append_run(rows, runs, run_id)
    found = table_sinks.read_runs(spark, runs)
    assert {row.run_id for row in found.collect()} == {"007", "08"}
    with pytest.raises(ValueError, match="run id"):
        table_sinks.append_run(rows, runs, "a/b")


def test_partitioned_table_scan_options():
    options = databases.jdbc_options(
        "jdbc:x", "orders", {"user": "u"}, key="order_id", bounds=(1, 9), connections=4
    )
    assert options["partitionColumn"] == "order_id"
    assert (options["lowerBound"], options["upperBound"]) == ("1", "9")
    assert (options["numPartitions"], options["preferTimestampNTZ"]) == ("4", "true")
    assert "partitionColumn" not in databases.jdbc_options("jdbc:x", "orders", {})
    with pytest.raises(ValueError, match="bounds"):
        databases.jdbc_options("jdbc:x", "orders", {}, key="order_id")


def test_run_folders_are_under_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = (workspace.new_run_folder(spark, "x") for _ in range(2))
    assert first != second
    assert first.startswith(f"{shared}/") and second.startswith(f"{shared}/")


@pytest.mark.parametrize(
    ("tebibytes", "split_mebibytes", "partitions"),
    [(0, 128, 8), (1, 128, 8192), (100, 1049, 100_000)],
)
def test_tasks_fit_the_input(tebibytes, split_mebibytes, partitions):
    sizes = workspace.task_sizes(tebibytes * 2**40, cores=8)
    split = int(sizes["spark.sql.files.maxPartitionBytes"])
    assert round(split / 2**20) == split_mebibytes
    assert int(sizes["spark.sql.shuffle.partitions"]) == partitions


def test_tasks_of_jobs_hold_little(spark, tables):
    """As much at 1 GB as at 50; never more than the usual sizes."""
    for gibibytes in (0, 1, 6, 50, 1024):
        sizes = {k: int(v) for k, v in workspace.job_sizes(gibibytes * 2**30, cores=12).items()}
        usual = workspace.task_sizes(gibibytes * 2**30, cores=12)
        assert all(sizes[key] >= 2**23 for key in sizes if "Bytes" in key)
        split, partitions = "spark.sql.files.maxPartitionBytes", "spark.sql.shuffle.partitions"
        assert sizes[split] <= int(usual[split])
        assert sizes[partitions] >= int(usual[partitions])
        if gibibytes <= 50:
            assert gibibytes * 2**30 / sizes[partitions] <= 2**23
            assert sizes["spark.sql.adaptive.advisoryPartitionSizeInBytes"] <= 2**23


@pytest.mark.parametrize("query", ["orders_dedup", "orders_dim", "orders_dim_filled"])
def test_queries_fit_their_tasks(spark, tables, query):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.unset(key)
    QUERIES[query](spark, tables)
    assert spark.conf.get(key) == str(workspace.HELD_BYTES)
    spark.conf.unset(key)


@pytest.fixture(scope="module")
def few_rows(spark, tmp_path_factory):
    """A folder with a few rows of each table that the loads read."""
    folder = str(tmp_path_factory.mktemp("few"))
    columns = {
        "lineitem": (
            "id + 1 AS l_orderkey", "id % 40 + 1 AS l_partkey", "double(id % 7 + 1) AS l_quantity",
            "double(id) + 0.5 AS l_extendedprice",
        ),
        "orders": (
            "id + 1 AS o_orderkey", "id % 9 AS o_custkey",
            "substr('FOP', int(id % 3) + 1, 1) AS o_orderstatus",
            "CAST(date_add(DATE'2024-01-01', int(id % 30)) AS timestamp_ntz) AS o_orderdate",
        ),
        "part": (
            "id + 1 AS p_partkey", "concat('item ', id) AS p_name",
            "concat('Brand#', id % 5) AS p_brand", "'STEEL' AS p_type", "int(id % 50) AS p_size",
        ),
        "events": ("id AS event_id", "id % 20 AS user_id", "'view' AS event_type"),
    }
    for name, named in columns.items():
        spark.range(40 if name == "part" else 300).selectExpr(*named).write.parquet(
            f"{folder}/{name}.parquet"
        )
    return folder


# Queries that load dimensions, or write what they read of the orders.
LOADING = [
    "describe_table",
    "fact_append_twice",
    "fact_replace_days",
    "load_counts",
    "show_tables",
    "sink_overwrite_idempotent",
    "sql_daily_orders",
    "sql_orders_fact",
    "stored_volume_by_warehouse_item",
    "table_statistics",
    "totals_daily_orders",
    "totals_summary",
    "sink_partitioned_by_warehouse",
    "sink_run_append",
    "orders_dedup",
]


@pytest.mark.parametrize("query", LOADING)
def test_partitions_of_loads_follow_the_input(spark, few_rows, query, monkeypatch):
    """However many bytes come, a task gets no more than it may hold of them."""
    monkeypatch.setattr(workspace, "HELD_BYTES", 512)
    merged, partitions = (
        "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions",
    )
    keys = (partitions, "spark.sql.files.maxPartitionBytes")
    before = {key: spark.conf.get(key) for key in keys}
    spark.conf.unset(merged)
    try:
        QUERIES[query](spark, few_rows)
        after = int(spark.conf.get(partitions)), spark.conf.get(merged)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
        spark.conf.unset(merged)
    assert after[0] > spark.sparkContext.defaultParallelism
    assert after[1] == "512"


def test_tasks_fit_files(spark, tables):
    keys = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")
    before = {key: spark.conf.get(key) for key in keys}
    workspace.fit_tasks(spark, tables, "/no/such/folder")
    after = {key: spark.conf.get(key) for key in keys}
    for key, value in before.items():
        spark.conf.set(key, value)
    assert after == {keys[0]: "8", keys[1]: str(128 * 2**20)}


def test_a_job_makes_a_plain_session_ready(spark, tables):
    """Settings that another session lacks, and partitions by the input's size."""
    changed = {
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "false",
        "spark.sql.shuffle.orderIndependentChecksum.enabled": "false",
        "spark.sql.shuffle.partitions": "200",
    }
    before = {key: spark.conf.get(key) for key in [*changed, "spark.sql.files.maxPartitionBytes"]}
    for key, value in changed.items():
        spark.conf.set(key, value)
    try:
        lines = spark.read.parquet(f"{tables}/lineitem.parquet")
        workspace.prepare(spark, lines, spark.createDataFrame([(1,)], "n int"))
        after = [spark.conf.get(key) for key in changed]
        size = workspace._scanned_bytes(lines)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert after == ["true", "true", "8"]
    assert 0 < size < 10**8
    assert workspace._scanned_bytes(spark.createDataFrame([(1,)], "n int")) < 10**6


def test_a_staged_table_goes_after_its_use(spark):
    with workspace.staged(spark.range(5), "staged") as rows:
        assert rows.count() == 5
        path = rows.inputFiles()[0].removeprefix("file:").lstrip("/")
        assert pathlib.Path("/" + path).exists()
    assert not pathlib.Path("/" + path).exists()


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]"])
def test_cluster_must_name_a_shared_folder(master):
    class Conf:
        def get(self, _key, default):
            return default

    class Context:
        pass

    Context.master = master

    class Session:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(RuntimeError, match=r"spark\.checkpoint\.dir"):
        workspace.shared_folder(Session())
