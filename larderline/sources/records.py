"""Put records together that a split of a file does not hold whole.

Text files are cut at a separator wherever it stands, also within a quoted value,
and large files are read in splits. What a piece between two separators is part
of depends on all that comes before it in its file: whether a quote is open, and
how deep brackets are nested. Both are sums. So each split is summed up on its
own, the sums of the splits before it tell how a split begins, and from there
each piece is known to begin a record or to go on with one.

Sums are narrow and shuffled by split. Lines are then read again and joined as
they come, a batch at a time and without a shuffle; pieces of nested documents are
shuffled by split, once. No more than a split's pieces come together in a task,
however large the file is, and of a record that spans splits the parts only.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larderline.workspace import new_run_folder

_SPLIT = ("file", "split", "size")


class Shape(NamedTuple):
    """What a ``piece`` does to the state: how many quotes it has that open or
    close a value, by how much it deepens the nesting if it begins outside of a
    value, and if it begins within one, and by how much the separator before it
    does, outside of a value. Lines, which are not nested, have quotes only."""

    quotes: Column
    outside: Column | None = None
    inside: Column | None = None
    separator: int = 0

    @property
    def is_flat(self) -> bool:
        return self.outside is None


class OpenQuoteError(ValueError):
    """A file ends within a quoted value."""


def pieces(spark: SparkSession, path: str, separator: str | None = None) -> DataFrame:
    """What stands between separators, with its place: ``file``, the ``split``
    by where it begins, its ``size``, ``line`` and ``piece``. Without a separator
    all kinds of line ends count."""
    reader = spark.read if separator is None else spark.read.option("lineSep", separator)
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.col("_metadata.file_block_length").alias("size"),
        F.monotonically_increasing_id().alias("line"),
        F.col("value").alias("piece"),
    )


def _written(rows: DataFrame, purpose: str) -> DataFrame:
    path = new_run_folder(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _before(window: Window) -> Window:
    return window.rowsBetween(Window.unboundedPreceding, -1)


def _sum_before(value: Column, window: Window) -> Column:
    return F.coalesce(F.sum(value).over(_before(window)), F.lit(0))


def _by_line() -> Window:
    return Window.partitionBy(*_SPLIT).orderBy("line")


def _is_inside(quotes: Column) -> Column:
    return quotes % 2 == 1


def _shaped(rows: DataFrame, shape: Shape, *carried: str) -> DataFrame:
    """The pieces with the quotes before each of them in its split, and by how
    much each deepens the nesting if the split begins outside a value, and within."""
    counted = rows.select(
        *_SPLIT,
        "line",
        *carried,
        shape.quotes.cast("long").alias("quotes"),
        (F.lit(0) if shape.is_flat else shape.outside).cast("long").alias("outside"),
        (F.lit(0) if shape.is_flat else shape.inside).cast("long").alias("inside"),
    )
    head = (F.col("split") == 0) & (F.row_number().over(_by_line()) == 1)
    placed = counted.withColumns(
        {"first": head, "quotes_before": _sum_before(F.col("quotes"), _by_line())}
    )
    turned = _is_inside(F.col("quotes_before"))
    outside = F.col("outside") + F.when(F.col("first"), 0).otherwise(shape.separator)
    return placed.withColumns(
        {
            "if_outside": F.when(turned, F.col("inside")).otherwise(outside),
            "if_inside": F.when(turned, outside).otherwise(F.col("inside")),
        }
    )


def _splits(rows: DataFrame, shape: Shape) -> DataFrame:
    """Each split with the quotes and the depth it begins with, written."""
    if shape.is_flat:
        # Nothing hangs on the order of the pieces, so the sums are made in map tasks.
        quotes = F.sum(shape.quotes).alias("quotes")
        none = [F.lit(0).alias(name) for name in ("if_outside", "if_inside")]
        sums = rows.groupBy(*_SPLIT).agg(quotes).select("*", *none)
    else:
        sums = (
            _shaped(rows, shape)
            .groupBy(*_SPLIT)
            .agg(*[F.sum(name).alias(name) for name in ("quotes", "if_outside", "if_inside")])
        )
    of_file = Window.partitionBy("file").orderBy("split")
    begun = sums.withColumn("quotes_then", _sum_before(F.col("quotes"), of_file))
    deeper = F.when(_is_inside(F.col("quotes_then")), F.col("if_inside")).otherwise(
        F.col("if_outside")
    )
    known = begun.withColumn("depth_then", _sum_before(deeper, of_file))
    return _written(known.select(*_SPLIT, "quotes", "quotes_then", "depth_then"), "splits")


def _require_closed(splits: DataFrame) -> None:
    total = splits.groupBy("file").agg(F.sum("quotes").alias("quotes"))
    broken = total.filter(_is_inside(F.col("quotes"))).first()
    if broken is not None:
        raise OpenQuoteError(f"a quote is never closed in {broken.file}")


@contextlib.contextmanager
def _same_splits(spark: SparkSession) -> Iterator[None]:
    """Files are cut alike all through the block, also if executors come or go, by
    whose number Spark cuts them otherwise."""
    setting = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(setting, None)
    if before is None:
        cores = spark.sparkContext.defaultParallelism
        now = spark.conf.get("spark.sql.leafNodeDefaultParallelism", None) or str(cores)
        spark.conf.set(setting, now)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(setting)


def _with_begin(pieces_seen: DataFrame, splits: DataFrame) -> DataFrame:
    """The pieces with the quotes and the depth that their split begins with."""
    met = pieces_seen.join(splits.drop("quotes"), list(_SPLIT), "left")
    # The files have to be cut as they were when splits were summed up.
    known = F.assert_true(
        F.col("quotes_then").isNotNull(), F.lit("files changed while they were read")
    )
    return met.filter(known.isNull())


_PARTS = "file string, split long, own long, text string, first boolean, edge boolean"


def _joiner(separator: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Joins the lines of splits, which come one after the other and in order.

    It is nested so that executors get it without this package.
    """

    def join_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        names = ["file", "split", "own", "text", "first", "edge"]
        # The split that is read, the record of it that goes on, counted from 0 and
        # None before the first, its lines so far, and whether a quote is open.
        at, own, held, inside = None, None, [], False

        def batch(texts: pa.Array, start: int | None, edge: bool) -> pa.RecordBatch:
            n, (file, split) = len(texts), at
            owns = pa.nulls(n, pa.int64()) if start is None else pa.array(range(start, start + n))
            first = np.zeros(n, dtype=bool)
            first[:1] = split == 0 and start == 0
            values = [
                pa.repeat(file, n),
                pa.repeat(pa.scalar(split, pa.int64()), n),
                owns.cast(pa.int64()),
                texts.cast(pa.string()),
                pa.array(first),
                pa.repeat(edge, n),
            ]
            return pa.RecordBatch.from_arrays(values, names=names)

        def held_record(edge: bool) -> Iterator[pa.RecordBatch]:
            if held:
                yield batch(pa.array([separator.join(held)], pa.string()), own, edge)

        def add(lines: pa.Array, odd: np.ndarray) -> Iterator[pa.RecordBatch]:
            nonlocal own, held, inside
            after = (np.cumsum(odd) + inside) % 2 == 1
            begins = np.flatnonzero(~np.concatenate([[inside], after[:-1]]))
            inside = bool(after[-1])
            if len(begins) == 0:
                held += lines.to_pylist()
                return
            held += lines[: begins[0]].to_pylist()
            # What a split begins with may go on from the one before it.
            yield from held_record(edge=own is None)
            own = 0 if own is None else own + 1
            whole = lines[begins[0] : begins[-1]]
            if len(whole):
                offsets = pa.array((begins - begins[0]).astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, whole)
                yield batch(pc.binary_join(lists, separator), own, edge=False)
                own += len(lists)
            held = lines[begins[-1] :].to_pylist()

        for some in batches:
            files = some.column("file").dictionary_encode()
            codes = files.indices.to_numpy(zero_copy_only=False)
            splits = some.column("split").to_numpy(zero_copy_only=False)
            odd = some.column("odd").to_numpy(zero_copy_only=False)
            turns = (np.diff(codes) != 0) | (np.diff(splits) != 0)
            cuts = [0, *(np.flatnonzero(turns) + 1).tolist(), len(splits)]
            for low, high in zip(cuts, cuts[1:]):
                if low == high:
                    continue
                here = (files.dictionary[int(codes[low])].as_py(), int(splits[low]))
                if here != at:
                    yield from held_record(edge=True)
                    at, own, held = here, None, []
                    inside = some.column("inside")[low].as_py()
                yield from add(some.column("piece").slice(low, high - low), odd[low:high])
        yield from held_record(edge=True)

    return join_lines


def _parts_of_lines(
    rows: DataFrame, shape: Shape, splits: DataFrame, separator: str
) -> DataFrame:
    """The records of each split, and the parts at its edges. The table of splits
    has a row for a split, so it is broadcast and lines stay where they are read."""
    # A task reads its splits one by one, each from front to back.
    seen = rows.select(*_SPLIT, "piece", _is_inside(shape.quotes).alias("odd"))
    begun = _with_begin(seen, F.broadcast(splits))
    inside = _is_inside(F.col("quotes_then")).alias("inside")
    return begun.select("file", "split", inside, "odd", "piece").mapInArrow(
        _joiner(separator), _PARTS
    )


def _parts_of_documents(
    rows: DataFrame, shape: Shape, splits: DataFrame, separator: str
) -> DataFrame:
    """The same where pieces are nested: they are shuffled by split."""
    met = _with_begin(_shaped(rows, shape, "piece"), splits)
    deeper = F.when(_is_inside(F.col("quotes_then")), F.col("if_inside")).otherwise(
        F.col("if_outside")
    )
    depth = F.col("depth_then") + _sum_before(deeper, _by_line())
    quotes = F.col("quotes_then") + F.col("quotes_before")
    begins = ~_is_inside(quotes) & (depth == 0)
    so_far = _by_line().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Windows and groups are by split alike, so the pieces move once.
    placed = met.withColumn("start", F.when(begins, F.col("line"))).withColumn(
        "own", F.max("start").over(so_far)
    )
    in_order = F.sort_array(F.collect_list(F.struct("line", "piece")))
    parts = placed.groupBy(*_SPLIT, "own").agg(
        in_order.alias("lines"), F.max("first").alias("first")
    )
    last = F.max("own").over(Window.partitionBy(*_SPLIT))
    return parts.select(
        "file",
        "split",
        "own",
        F.array_join(F.col("lines.piece"), separator).alias("text"),
        "first",
        (F.col("own").isNull() | (F.col("own") == last)).alias("edge"),
    )


def joined(rows: DataFrame, shape: Shape, separator: str) -> DataFrame:
    """The records that the ``pieces`` make up: ``file``, ``record``, and whether
    it is the ``first`` of its file. Their parts are written to the shared folder.

    A file that ends within a quoted value is refused.
    """
    parts_of = _parts_of_lines if shape.is_flat else _parts_of_documents
    with _same_splits(rows.sparkSession):
        splits = _splits(rows, shape)
        _require_closed(splits)
        stored = _written(parts_of(rows, shape, splits, separator), "records")
    # What a split begins with goes on from the last record of one before it.
    in_file = Window.partitionBy("file").orderBy("split", F.col("own").asc_nulls_first())
    number = F.count("own").over(in_file.rowsBetween(Window.unboundedPreceding, 0))
    in_turn = F.sort_array(F.collect_list(F.struct("split", "text")))
    over_edges = (
        stored.filter("edge")
        .withColumn("number", number)
        .groupBy("file", "number")
        .agg(in_turn.alias("texts"), F.max("first").alias("first"))
        .select("file", F.array_join(F.col("texts.text"), separator).alias("record"), "first")
    )
    inner = stored.filter("NOT edge").select("file", F.col("text").alias("record"), "first")
    return inner.unionByName(over_edges)
