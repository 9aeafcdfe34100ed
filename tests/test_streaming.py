"""Streams that stop and go on, get late and repeated events, and agree with
the batch result."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from larderline.plans import dims, facts
from larderline.sinks.topics import publish_to_folder
from larderline.sources import files, topics
from larderline.streaming import events, late, sinks
from larderline.workspace import remembered
from larder_checks import inputs

START = int(dt.datetime(2025, 7, 1, tzinfo=dt.timezone.utc).timestamp())


class Topic:
    """A folder of message files that arrive one by one."""

    def __init__(self, path):
        self.path = path
        path.mkdir()
        self.files = 0

    def arrive(self, *messages):
        self.files += 1
        lines = "\n".join(m if isinstance(m, str) else json.dumps(m) for m in messages)
        file = self.path / f"{self.files:03}.txt"
        file.write_text(lines)
        # Files are read in order of their times, which may else be the same.
        os.utime(file, (START + self.files, START + self.files))


@pytest.fixture
def gps(tmp_path):
    return Topic(tmp_path / "gps")


@pytest.fixture
def status(tmp_path):
    return Topic(tmp_path / "status")


def position(courier, seconds, lat=1.5):
    return {"courier_id": courier, "lat": lat, "lon": 2, "ts": START + seconds}


def change(order, courier, seconds, name="shipped"):
    return {"order_id": order, "courier_id": courier, "status": name, "ts": START + seconds}


def gps_stream(spark, topic):
    return dims.gps_dim(topics.gps_events(topics.folder_stream(spark, str(topic.path))))


def status_stream(spark, topic):
    return dims.status_dim(topics.status_events(topics.folder_stream(spark, str(topic.path))))


def test_messages_are_cleaned_and_a_restart_goes_on(spark, tmp_path, gps):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        sinks.load_batches(gps_stream(spark, gps), out, checkpoint).awaitTermination()
        return sorted(
            (row.courier_id, row.lat) for row in spark.read.parquet(out).collect()
        )

    gps.arrive(position("C001", 0), position("C002", 1, lat="bad"), "no json at all")
    assert run() == [("c001", 1.5)]
    gps.arrive(position("C003", 2, lat=-7))
    assert run() == [("c001", 1.5), ("c003", -7.0)]
    assert run() == [("c001", 1.5), ("c003", -7.0)]


def test_many_small_batches_give_the_same(spark, tmp_path, gps):
    for number in range(5):
        gps.arrive(position(f"C{number:03}", number))
    messages = topics.folder_stream(spark, str(gps.path), files_per_batch=2)
    out = str(tmp_path / "out")
    stream = dims.gps_dim(topics.gps_events(messages))
    query = sinks.load_batches(stream, out, str(tmp_path / "checkpoint"))
    query.awaitTermination()
    result = spark.read.parquet(out)
    assert sorted(row.batch_id for row in result.collect()) == [0, 0, 1, 1, 2]
    assert result.select("courier_id").distinct().count() == 5


def test_a_repeated_batch_replaces_its_rows(spark, tmp_path, gps):
    gps.arrive(position("C001", 0), position("C002", 1))
    out = str(tmp_path / "out")
    for attempt in ("first", "second"):
        stream = gps_stream(spark, gps)
        sinks.load_batches(stream, out, str(tmp_path / attempt)).awaitTermination()
    assert spark.read.parquet(out).count() == 2


def test_csv_files_as_they_arrive(spark, tmp_path):
    arriving, out = tmp_path / "gps", str(tmp_path / "out")
    arriving.mkdir()

    def run():
        stream = dims.gps_dim(files.stream_gps_csv(spark, str(arriving)))
        sinks.load_batches(stream, out, str(tmp_path / "checkpoint")).awaitTermination()
        return spark.read.parquet(out).count()

    (arriving / "1.csv").write_text("courier_id,lat,lon,ts\nC001,1,2,7\nC001,bad,2,7\n")
    assert run() == 1
    (arriving / "2.csv").write_text('courier_id,lat,lon,ts\n"C\n002,1,2,8",1,2,8\n')
    assert run() == 2
    (arriving / "3.csv").write_text("ts,lat,lon,courier_id\n8,1,2,C003\n")
    with pytest.raises(StreamingQueryException):
        run()


def test_a_torn_csv_row_stops_the_stream(spark, tmp_path):
    (tmp_path / "gps").mkdir()
    (tmp_path / "gps" / "1.csv").write_text('courier_id,lat,lon,ts\nC001,1,2,"7\nC002,1,2,8\n')
    stream = dims.gps_dim(files.stream_gps_csv(spark, str(tmp_path / "gps")))
    with pytest.raises(StreamingQueryException, match="torn row"):
        sinks.load_batches(stream, str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()


def test_order_ids_sent_as_text(spark, tmp_path, status):
    status.arrive(change("7", "C001", 0), change("x", "C001", 1))
    out = str(tmp_path / "out")
    stream = status_stream(spark, status)
    sinks.append_to_folder(stream, out, str(tmp_path / "checkpoint")).awaitTermination()
    rows = spark.read.parquet(out).collect()
    assert sorted(row.order_id or 0 for row in rows) == [0, 7]
    assert rows[0].courier_id == "c001"


@pytest.mark.parametrize("parts", [None, (5, 1), (1, 4), (3, 2)])
def test_tracking_is_exact_at_the_bound(spark, tmp_path, gps, status, parts):
    hour = 3600
    gps.arrive(*[position("C001", s) for s in (0, hour, hour + 1, 2 * hour, 5 * hour)])
    gps.arrive(position("C002", 0))
    status.arrive(change("1", "C001", hour), change("2", "C001", 3 * hour + 1))
    out = str(tmp_path / "out")
    schema = "courier_id string, gps_parts int, status_parts int"
    busy = parts and spark.createDataFrame([("c001", *parts)], schema)
    tracked = events.track_couriers(
        gps_stream(spark, gps), status_stream(spark, status), hour, "1 day", busy
    )
    sinks.append_to_folder(tracked, out, str(tmp_path / "checkpoint")).awaitTermination()
    pairs = sorted(
        (row.order_id, int((row.gps_ts - dt.datetime(2025, 7, 1)).total_seconds()))
        for row in spark.read.parquet(out).collect()
    )
    assert pairs == [(1, 0), (1, hour), (1, hour + 1), (1, 2 * hour)]


def test_a_bound_beyond_the_history_gives_the_batch_fact(spark, tables, tmp_path):
    gps, status = inputs.gps_raw(spark, tables), inputs.status_raw(spark, tables)
    publish_to_folder(gps, str(tmp_path / "gps"))
    publish_to_folder(status, str(tmp_path / "status"))
    positions = topics.gps_events(topics.folder_stream(spark, str(tmp_path / "gps")))
    changes = topics.status_events(topics.folder_stream(spark, str(tmp_path / "status")))
    tracked = events.track_couriers(
        dims.gps_dim(positions), dims.status_dim(changes), 1000 * 86400, "1 day"
    )
    out = str(tmp_path / "out")
    sinks.append_to_folder(tracked, out, str(tmp_path / "checkpoint")).awaitTermination()
    # Nothing is within a bound of an unknown time.
    batch = facts.courier_tracking(
        dims.gps_dim(gps).filter("gps_ts IS NOT NULL"), dims.status_dim(status)
    )
    stream = spark.read.parquet(out)
    assert stream.count() == batch.count()
    assert stream.exceptAll(batch).isEmpty()


def test_busy_couriers_are_few(spark):
    courier = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
    positions = spark.range(3000).select(courier.alias("courier_id"))
    changes = positions.withColumn("courier_id", F.lit("c7")).limit(600).unionByName(positions)
    busy = sorted(map(tuple, events.busy_couriers(positions, changes, share=0.05).collect()))
    # One is busy in both feeds, the other has status events only.
    assert busy == [("c7", 1, 4), ("hot", 7, 6)]
    nothing = positions.limit(0)
    assert events.busy_couriers(nothing, nothing).count() == 0


def test_the_busy_list_is_made_once(spark, tmp_path):
    path = str(tmp_path / "busy")
    for rows in (3, 5):
        assert remembered(spark, path, lambda rows=rows: spark.range(rows)).count() == 3


def test_tracking_meets_across_restarts_and_drops_old_state(spark, tmp_path, gps, status):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        tracked = events.track_couriers(
            gps_stream(spark, gps), status_stream(spark, status), 3600, "1 hour"
        )
        query = sinks.append_to_folder(tracked, out, checkpoint)
        query.awaitTermination()
        kept = query.lastProgress["stateOperators"][0]["numRowsTotal"]
        return spark.read.parquet(out).count(), kept

    gps.arrive(position("C001", 0))
    status.arrive(change("1", "C009", 0))
    assert run()[0] == 0
    status.arrive(change("1", "C001", 1800))
    found, kept = run()
    assert (found, kept > 0) == (1, True)
    gps.arrive(position("C002", 10 * 86400))
    status.arrive(change("2", "C003", 10 * 86400))
    assert run()[0] == 1
    gps.arrive(position("C004", 20 * 86400))
    status.arrive(change("3", "C005", 20 * 86400))
    found, now_kept = run()
    assert found == 1
    # Only the newest position and the copies of the newest status are left.
    assert now_kept <= 1 + 2


def test_state_is_bounded_by_the_watermark(spark, tmp_path, gps, status):
    """Five deliveries a day apart: what is kept is that of the last ones."""
    checkpoint, day = str(tmp_path / "checkpoint"), 86_400
    for number in range(5):
        gps.arrive(*[position(f"C{n:03}", number * day + n) for n in range(40)])
        status.arrive(*[change(str(n), f"C{n + 50:03}", number * day + n) for n in range(40)])
        tracked = events.track_couriers(
            gps_stream(spark, gps), status_stream(spark, status), 3600, "1 hour"
        )
        sinks.append_to_folder(tracked, str(tmp_path / "out"), checkpoint).awaitTermination()
        positions = sinks.stored_state(spark, checkpoint, side="left")
        changes = sinks.stored_state(spark, checkpoint, side="right")
        # A status event may stand in two slots of time.
        assert 0 < positions.count() <= 2 * 40 and 0 < changes.count() <= 2 * 2 * 40
    sizes = sinks.state_sizes(positions).collect()
    assert sum(row.state_rows for row in sizes) == positions.count()
    assert len(sizes) > 1 and max(row.state_keys for row in sizes) < 40


def test_state_of_redelivery_is_bounded_by_the_watermark(spark, tmp_path, status):
    checkpoint, day = str(tmp_path / "checkpoint"), 86_400
    for number in range(4):
        status.arrive(*[change(str(n), "C001", number * 3 * day + n) for n in range(30)] * 2)
        once = events.without_repeats(status_stream(spark, status), "1 day")
        sinks.append_to_folder(once, str(tmp_path / "out"), checkpoint).awaitTermination()
        for step in (0, 1):
            kept = sinks.state_sizes(sinks.stored_state(spark, checkpoint, step))
            assert 0 < sum(row.state_keys for row in kept.collect()) <= 2 * 2 * 30


def test_status_totals_go_on(spark, tmp_path, status):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        counts = events.status_counts(status_stream(spark, status))
        sinks.keep_latest(counts, out, checkpoint).awaitTermination()
        return {row.status: row.event_count for row in sinks.read_latest(spark, out).collect()}

    status.arrive(change("1", "C001", 0, "NEW"), change("1", "C001", 1, "Shipped"))
    assert run() == {"new": 1, "shipped": 1}
    status.arrive(change("2", "C001", 2, "shipped"))
    assert run() == {"new": 1, "shipped": 2}


def test_totals_stay_while_the_next_ones_are_written(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        sinks.read_latest(spark, str(tmp_path))
    spark.range(3).write.parquet(f"{tmp_path}/total-a")
    half = tmp_path / "total-b"
    half.mkdir()
    (half / "part-0.parquet").write_bytes(b"half")
    assert sinks.read_latest(spark, str(tmp_path)).count() == 3


def test_late_rows_are_kept_apart_and_nothing_else_is_lost(spark, tmp_path, status):
    day = 86_400
    status.arrive(change("1", "C001", 10 * day), change("2", "C001", 0))
    status.arrive(change("3", "C001", 8 * day), change("4", "C001", 9 * day + 1))
    status.arrive(change("5", "C001", 30 * day), change("6", "C001", 29 * day))
    status.arrive(change("7", "C001", 1 * day))
    messages = topics.folder_stream(spark, str(status.path), files_per_batch=1)
    stream = dims.status_dim(topics.status_events(messages))
    path = str(tmp_path / "split")
    for _ in range(2):  # the second run finds nothing new
        late.split_late(stream, "status_ts", day, path, f"{path}/checkpoint").awaitTermination()
    in_time = late.on_time(spark, path, stream, files_per_batch=1)
    once = events.without_repeats(in_time, "1 day")
    out = str(tmp_path / "once")
    query = sinks.append_to_folder(once, out, str(tmp_path / "checkpoint"))
    query.awaitTermination()
    found = sorted(row.order_id for row in spark.read.parquet(out).collect())
    behind = sorted(row.order_id for row in late.late_rows(spark, path, stream).collect())
    assert (found, behind) == ([1, 4, 5, 6], [2, 3, 7])
    assert sinks.dropped_rows(query) == 0
    # Without the split the stateful step drops them, and says how many.
    bare = events.without_repeats(stream, "1 day")
    query = sinks.append_to_folder(bare, str(tmp_path / "bare"), str(tmp_path / "bare-checkpoint"))
    query.awaitTermination()
    assert sinks.dropped_rows(query) > 0


def test_redelivery_is_dropped_across_batches(spark, tmp_path, status):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        once = events.without_repeats(status_stream(spark, status), "1 day")
        sinks.append_to_folder(once, out, checkpoint).awaitTermination()
        return sorted(row.order_id for row in spark.read.parquet(out).collect())

    status.arrive(*[change("1", "C001", 0)] * 50, change("2", "C001", 0))
    assert run() == [1, 2]
    status.arrive(change("1", "C001", 0), change("3", "C001", 5))
    assert run() == [1, 2, 3]
