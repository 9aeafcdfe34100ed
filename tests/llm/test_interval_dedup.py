"""Repeated strings of bytes against all strings of small tables, one by one."""

from __future__ import annotations

import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from larderline.llm import interval_dedup
from larderline.llm.queries import QUERIES

SCHEMA = "doc_id long, text string"


def plain(texts, least):
    """What stays of each text, and the spans that go."""
    contents = [(text or "").encode() for text in texts]
    seen = Counter(c[i : i + least] for c in contents for i in range(len(c) - least + 1))
    found = []
    for content in contents:
        gone = np.zeros(len(content) + 1, dtype=bool)
        for i in range(len(content) - least + 1):
            if seen[content[i : i + least]] > 1:
                gone[i : i + least] = True
        edges = np.flatnonzero(np.diff(gone.astype(int), prepend=0)).tolist()
        kept = bytes(b for b, out in zip(content, gone[:-1], strict=True) if not out)
        found.append((kept, list(zip(edges[::2], edges[1::2], strict=True))))
    return found


def removed(spark, texts, least, schema=SCHEMA):
    docs = spark.createDataFrame(list(enumerate(texts)), schema).repartition(3)
    rows = interval_dedup.remove_repeated_bytes(docs, least_bytes=least).collect()
    by_id = {r.id: (bytes(r.kept), [tuple(s) for s in r.spans]) for r in rows}
    assert len(rows) == len(texts)
    return [by_id[n] for n in range(len(texts))]


def some_texts(seed, count=60):
    """Texts of several kinds that share passages of many lengths."""
    draw = random.Random(seed)
    letters = "abcdeéü \n"

    def fresh(n):
        return "".join(draw.choices(letters, k=n))

    shared = [fresh(draw.randint(20, 150)) for _ in range(6)]
    texts = [None, "", "ab" * 60, "a" * 90, fresh(31), fresh(40) * 3]
    while len(texts) < count:
        parts = [fresh(draw.randint(0, 60))]
        for _ in range(draw.randint(0, 4)):
            piece = draw.choice(shared)
            first = draw.randint(0, len(piece) // 2)
            parts += [piece[first : draw.randint(first, len(piece))], fresh(draw.choice([0, 1, 30]))]
        texts.append("".join(parts))
    return [*texts, texts[-1], texts[-2][:-1] + "!"]


@pytest.mark.parametrize("seed", [1, 2])
def test_all_repeated_strings_go_and_no_others(spark, seed):
    texts = some_texts(seed)
    assert removed(spark, texts, 32) == plain(texts, 32)


def test_crowded_anchors_are_cut_finer(spark, monkeypatch):
    monkeypatch.setattr(interval_dedup, "PIECES_TOGETHER", 3)
    texts = some_texts(3)
    assert removed(spark, texts, 40) == plain(texts, 40)


def test_transform_tells_repeated_starts():
    draw = random.Random(4)
    for _ in range(40):
        texts = [bytes(draw.choices(b"ab\x00\xff", k=draw.randint(0, 40))) for _ in range(draw.randint(1, 6))]
        least = draw.randint(1, 12)
        seen = Counter(t[i : i + least] for t in texts for i in range(len(t) - least + 1))
        wanted = [
            [i for i in range(len(t) - least + 1) if seen[t[i : i + least]] > 1] for t in texts
        ]
        found = [s.tolist() for s in interval_dedup.repeated_starts(texts, least)]
        assert found == wanted


def test_pieces_hold_each_window_once_whatever_the_block(monkeypatch):
    draw = np.random.default_rng(6)
    text = draw.integers(0, 5, 20_000).astype(np.uint8).tobytes()

    def windows(of):
        return [
            (int(s) + w, int(s) + int(at), int(core))
            for starts, counts, ats, cores in interval_dedup._anchored(of, 64)
            for s, n, at, core in zip(starts, counts, ats, cores, strict=True)
            for w in range(n)
        ]

    whole = windows(text)
    assert [w for w, _, _ in whole] == list(range(20_000 - 63))
    monkeypatch.setattr(interval_dedup, "WINDOWS_AT_ONCE", 700)
    assert windows(text) == whole
    later = {w + 1000: (at + 1000, core) for w, at, core in windows(text[1000:])}
    assert all(later[w] == (at, core) for w, at, core in whole if w >= 1000)


def test_finer_pieces_hold_each_window_once():
    draw = random.Random(8)
    for _ in range(200):
        windows, step = draw.randint(1, 60), draw.choice([1, 4, 16])
        anchor = draw.randint(windows - 1, 100)
        parts = list(interval_dedup._finer(bytes(windows + 63), anchor, 64, step))
        assert sorted(f + w for f, n, _, _ in parts for w in range(n)) == list(range(windows))
        assert all(n <= step and first + at == anchor for first, n, at, _ in parts)


def test_equal_and_null_ids_and_clashing_columns(spark):
    long = "".join(random.Random(9).choices("abcdefgh ", k=300))
    rows = [(None, long, "x", 1, b""), (None, "tail " + long, "y", 2, b""), (7, "other", "z", 3, b"")]
    schema = "doc_id long, text string, id string, row int, kept binary"
    found = interval_dedup.remove_repeated_bytes(spark.createDataFrame(rows, schema), least_bytes=100)
    kept = sorted((r.n_bytes, bytes(r.kept)) for r in found.collect())
    assert kept == [(5, b"other"), (300, b""), (305, b"tail ")]


def test_empty_table(spark):
    assert interval_dedup.remove_repeated_bytes(spark.createDataFrame([], SCHEMA)).collect() == []


def test_short_strings_are_refused(spark):
    with pytest.raises(ValueError):
        interval_dedup.remove_repeated_bytes(spark.createDataFrame([], SCHEMA), least_bytes=20)


def test_spans_are_merged_in_little_memory():
    # As plain Python values they take some 250 bytes each.
    rows, spans = 2_000, 100
    starts = np.tile(np.arange(spans) * 10, rows)
    places = pa.StructArray.from_arrays(
        [pa.array(starts), pa.array(starts + np.where(starts % 30 == 0, 15, 5))], ["start", "end"]
    )
    lists = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * spans, pa.int32()), places)
    ids = pa.array(np.arange(rows))
    batch = pa.record_batch([ids, ids, lists], names=["own_id", "own_row", "spans"])
    wanted = interval_dedup._merged([(s["start"], s["end"]) for s in lists[0].as_py()])
    assert 1 < len(wanted) < spans
    tracemalloc.start()
    (merged,) = interval_dedup._merge([batch])
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 100 * rows * spans
    assert merged.schema == batch.schema
    for row in merged.column("spans").to_pylist():
        assert [(s["start"], s["end"]) for s in row] == wanted


def test_rows_are_handed_over_in_small_batches(spark):
    interval_dedup.remove_repeated_bytes(spark.createDataFrame([], SCHEMA))
    texts = spark.range(0, 400, 1, 1).select(F.repeat(F.lit("text "), 20_000).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.nbytes])], names=["size"])

    found = [r["size"] for r in texts.mapInArrow(sizes, "size long").collect()]
    assert sum(found) >= 400 * 100_000
    assert max(found) < 2 * interval_dedup.BATCH_BYTES


def test_many_pieces_of_one_anchor_are_shared_out(spark, monkeypatch):
    tables, store = {}, interval_dedup.store

    def kept(rows, purpose):
        tables[purpose], path = store(rows, purpose)
        return tables[purpose], path

    monkeypatch.setattr(interval_dedup, "store", kept)
    monkeypatch.setattr(interval_dedup, "drop_folder", lambda *_: None)
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.files.maxPartitionBytes": "64k",
        "spark.sql.files.openCostInBytes": "1k",
    }
    before = {key: spark.conf.get(key) for key in small}
    number = F.col("id")
    heavy = number % 2 == 0
    pieces = spark.range(0, 40_000, 1, 16).select(
        number,
        *[number.alias(name) for name in ("row", "start", "windows", "anchor", "high", "low", "piece")],
        F.when(heavy, F.lit(-1)).otherwise(number % 5_000).cast("long").alias("core"),
    )
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        assert interval_dedup._marked(pieces).count() == 40_000
        alive = tables["alive"].filter("core = -1").groupBy(F.input_file_name()).count()
        most = alive.agg(F.max("count")).first()[0]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert most < 20_000 / 2


def test_query_on_the_test_table(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").collect()
    wanted = plain([r.text for r in docs], 400)
    found = {r.doc_id: r for r in QUERIES["op13_interval_dedup"](spark, tables).collect()}
    assert len(found) == len(docs)
    for row, (kept, spans) in zip(docs, wanted, strict=True):
        own = found[row.doc_id]
        size = len((row.text or "").encode())
        assert (own.n_bytes, own.n_removed, own.n_spans) == (size, size - len(kept), len(spans))
        assert own.kept_sha256 == hashlib.sha256(kept).hexdigest()
    assert sum(bool(spans) for _, spans in wanted) > 10
