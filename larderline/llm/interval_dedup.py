"""Remove each byte of a string of some length that starts anywhere else as well.

Strings of that length are told to be repeated by a Burrows-Wheeler transform:
from the interval of the empty string on, all intervals are extended backward,
breadth first, which yields the common prefixes of neighbouring suffixes by
increasing length. It stops at the wanted length; what has no value by then is
repeated.

No transform of the whole corpus is made. Of all short strings within a window
of the wanted length, the one of least hash is its anchor: windows that are equal
have the same anchor at the same place. The windows of a text that share an anchor
make a piece, and every window is in one piece. Pieces meet by the hash of their
anchor. Equal pieces are counted, not compared; pieces that differ share a
transform. Should very many different pieces share one anchor, they are cut into
finer ones, whose common part is longer, down to single windows.
"""

from __future__ import annotations

import functools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from larderline.llm.common import broadcast_if_small, equip, store, stored
from larderline.workspace import drop_folder

LEAST_BYTES = 400
# An anchor is this part of the window, so a text has an anchor about every
# 3 / 8 of a window.
ANCHORS_IN_WINDOW = 4

# Texts or pieces of a batch that are worked on at a time, and windows of a text
# whose anchors are looked for at a time.
TEXTS_AT_ONCE = 1000
WINDOWS_AT_ONCE = 1 << 18
# Bytes of rows that are handed to Python at a time. Spark fills a batch in memory
# beside its heap, up to several times what the batch holds in the end.
BATCH_BYTES = 4 << 20
# Different pieces that are compared in one transform if they share an anchor,
# and bytes from which on a transform takes no further anchors in.
PIECES_TOGETHER = 250
BYTES_TOGETHER = 1 << 19
# Windows in the parts of pieces that are compared; parts whose windows share
# nothing with those of another piece are left out.
COMPARED_WINDOWS = 64
# Windows in the finer pieces of a crowded anchor, then in those of a crowded
# finer piece. Pieces of one window differ or are equal.
FINER = (16, 1)

_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)


@functools.lru_cache(maxsize=2)
def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base of the rolling hash, and of its inverse."""

    def powers(base: int) -> np.ndarray:
        factors = np.full(length, base, dtype=np.uint64)
        factors[0] = 1
        return np.multiply.accumulate(factors)

    return powers(_BASE), powers(pow(_BASE, -1, 2**64))


def _mixed(hashes: np.ndarray) -> np.ndarray:
    hashes ^= hashes >> np.uint64(32)
    hashes *= _MIX
    hashes ^= hashes >> np.uint64(29)
    hashes *= _MIX
    hashes ^= hashes >> np.uint64(32)
    return hashes


def _gram_hashes(block: np.ndarray, size: int, at_once: int) -> np.ndarray:
    """A hash of each string of ``size`` bytes in the block."""
    up, down = _powers(at_once)
    sums = np.zeros(len(block) + 1, dtype=np.uint64)
    np.cumsum((block.astype(np.uint64) + np.uint64(1)) * up[: len(block)], out=sums[1:])
    return _mixed((sums[size:] - sums[:-size]) * down[: len(block) + 1 - size])


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring values."""
    rows = -(-len(values) // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(values)] = values
    table = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(values) - width + 1
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])


def _anchored(text: bytes, least: int) -> Iterator[tuple[np.ndarray, ...]]:
    """First window, number of windows, place of the anchor behind the first
    window, and hash of the anchor, of the pieces of a text, block by block."""
    gram = max(1, least // ANCHORS_IN_WINDOW)
    at_once = WINDOWS_AT_ONCE + least
    low = np.uint64(2**32 - 1)
    for first in range(0, len(text) - least + 1, WINDOWS_AT_ONCE):
        block = np.frombuffer(text, np.uint8, min(at_once - 1, len(text) - first), first)
        hashes = _gram_hashes(block, gram, at_once)
        # The place in the lower half: of equal hashes the first is the least.
        ranked = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
        anchors = (_sliding_least(ranked, least - gram + 1) & low).astype(np.int64)
        starts = np.flatnonzero(np.diff(anchors, prepend=-1))
        windows = np.diff(starts, append=len(anchors))
        at = anchors[starts]
        yield starts + first, windows, at - starts, hashes[at].view(np.int64)


def _finer(piece: bytes, anchor: int, least: int, step: int) -> Iterator[tuple[int, int, int, int]]:
    """As ``_anchored`` for the parts of a piece, of up to ``step`` windows each,
    counted from the anchor on, and the hash of what their windows share."""
    windows = len(piece) - least + 1
    for part in range(max(anchor - windows + 1, 0) // step, anchor // step + 1):
        first = max(anchor - step * part - step + 1, 0)
        last = min(anchor - step * part, windows - 1)
        if first <= last:
            core_first = anchor - step * part
            core = piece[core_first : core_first + least - step + 1]
            yield first, last - first + 1, anchor - first, xxhash.xxh3_64_intdigest(core, part)


_PLACE = ("id", "row", "start", "windows", "anchor")
_HASHES = ("core", "high", "low")


def _piece_schema(docs: DataFrame) -> T.StructType:
    names = ("row", "start", "windows", "anchor", *_HASHES)
    return T.StructType([docs.schema["id"], *[T.StructField(n, T.LongType()) for n in names]])


def _piece_batch(batch, rows, starts, windows, anchors, cores, digests, schema) -> pa.RecordBatch:
    """Pieces of the rows of a batch as a batch."""
    taken = batch.select(["id", "row"]).take(pa.array(rows, pa.int64()))
    halves = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
    numbers = [starts, windows, anchors, cores, halves[:, 0], halves[:, 1]]
    return pa.record_batch([*taken.columns, *[pa.array(n, pa.int64()) for n in numbers]], schema=schema)


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)


def _in_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, len(batch), TEXTS_AT_ONCE):
            yield batch.slice(first, TEXTS_AT_ONCE)


def _pieces(least: int, schema: pa.Schema):
    """Reads ``id``, ``row`` and ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _in_parts(batches):
            rows, found, digests = [], [], []
            for row, text in enumerate(batch.column("text").cast(pa.binary())):
                content = text.as_py() or b""
                view = memoryview(content)
                for starts, windows, anchors, cores in _anchored(content, least):
                    ends = (starts + windows + (least - 1)).tolist()
                    digests += [
                        xxhash.xxh3_128_digest(view[a:b])
                        for a, b in zip(starts.tolist(), ends, strict=True)
                    ]
                    rows.append(np.full(len(starts), row))
                    found.append((starts, windows, anchors, cores))
            columns = [_joined([part[n] for part in found]) for n in range(4)]
            yield _piece_batch(batch, _joined(rows), *columns, digests, schema)

    return run


def _finer_pieces(least: int, step: int, schema: pa.Schema):
    """Reads ``id``, ``row``, ``start``, ``anchor`` and ``content`` of pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _in_parts(batches):
            rows, found, digests = [], [], []
            columns = [batch.column(n).to_pylist() for n in ("start", "anchor", "content")]
            for row, (start, anchor, content) in enumerate(zip(*columns, strict=True)):
                for first, windows, at, core in _finer(content, anchor, least, step):
                    rows.append(row)
                    found.append((start + first, windows, at, core))
                    digests.append(xxhash.xxh3_128_digest(content[first : first + windows + least - 1]))
            table = np.array(found, dtype=np.uint64).reshape(-1, 4).view(np.int64)
            yield _piece_batch(batch, rows, *[table[:, n] for n in range(4)], digests, schema)

    return run


def _sorted_rotations(text: np.ndarray, depth: int) -> np.ndarray:
    """The rotations of a text by their first ``depth`` symbols at least, each of
    nine bits, by doubling the length they are sorted by."""
    keys = np.zeros(len(text), dtype=np.uint64)
    length = 7
    for step in range(length):
        keys <<= np.uint64(9)
        keys |= np.roll(text, -step)
    while True:
        order = np.argsort(keys)
        ordered = keys[order]
        ranks = np.empty(len(text), dtype=np.uint64)
        ranks[order] = np.cumsum(np.concatenate([[False], ordered[1:] != ordered[:-1]]))
        if length >= depth:
            return order
        keys = (ranks << np.uint64(32)) | np.roll(ranks, -length)
        length *= 2


def repeated_starts(texts: list[bytes], least: int) -> list[np.ndarray]:
    """Where strings of ``least`` bytes start that also start elsewhere, in each
    of the texts."""
    # Symbol 0 ends a text; it is in no string of a text.
    text = np.concatenate([np.frombuffer(t + b"\0", np.uint8).astype(np.uint16) + 1 for t in texts])
    ends = np.cumsum([len(t) + 1 for t in texts])
    text[ends - 1] = 0
    size = len(text)
    suffixes = _sorted_rotations(text, least)
    transform = text[suffixes - 1]
    by_symbol = np.argsort(transform, kind="stable").astype(np.int32)
    extended = np.empty(size, dtype=np.int32)
    extended[by_symbol] = np.arange(size, dtype=np.int32)
    # The neighbouring places of the same symbol in the transform.
    alike = transform[by_symbol[1:]] == transform[by_symbol[:-1]]
    before, after = np.full(size, -1, np.int32), np.full(size, size, np.int32)
    after[by_symbol[:-1][alike]] = by_symbol[1:][alike]
    before[by_symbol[1:][alike]] = by_symbol[:-1][alike]

    common = np.full(size + 1, -1, dtype=np.int32)
    common[[0, size]] = 0
    lows, highs = np.array([0], np.int32), np.array([size], np.int32)
    for length in range(least):
        sizes = highs - lows
        offsets = np.cumsum(sizes, dtype=np.int32) - sizes
        places = np.arange(sizes.sum(), dtype=np.int32) + np.repeat(lows - offsets, sizes)
        firsts = places[before[places] < np.repeat(lows, sizes)]
        lasts = places[after[places] >= np.repeat(highs, sizes)]
        # The extended intervals are disjoint, so sorted ends belong together.
        lows, highs = np.sort(extended[firsts]), np.sort(extended[lasts]) + 1
        new = common[highs] < 0
        lows, highs = lows[new], highs[new]
        if not len(lows):
            break
        common[highs] = length
    shared = np.flatnonzero(common < 0)
    repeated = np.zeros(size, dtype=bool)
    repeated[suffixes[shared]] = repeated[suffixes[shared - 1]] = True
    found = []
    for end, own in zip(ends.tolist(), texts, strict=True):
        first = end - len(own) - 1
        found.append(np.flatnonzero(repeated[first : max(first, end - least)]))
    return found


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that do not touch, in order."""
    merged = []
    for start, end in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


def _alike_parts(group: list[tuple], least: int) -> Iterator[dict[bytes, list]]:
    """Parts of pieces of one anchor that may share a string: content, and the
    pieces and places that have it. The others share none with another piece."""
    step = min(COMPARED_WINDOWS, least // 2)
    alike: dict[int, dict[bytes, list]] = defaultdict(dict)
    for number, (_, _, _, _, anchor, content) in enumerate(group):
        for first, windows, _, core in _finer(content, anchor, least, step):
            part = content[first : first + windows + least - 1]
            alike[core].setdefault(part, []).append((number, first))
    for parts in alike.values():
        if len(parts) > 1 or any(len(places) > 1 for places in parts.values()):
            yield parts


def _spans_of(groups: list[list[tuple]], least: int) -> Iterator[tuple]:
    """Repeated spans of pieces, which are grouped by anchor."""

    def at(place: tuple, start: int, end: int) -> tuple:
        group, (number, first) = place
        _, own_id, own_row, begin, _, _ = group[number]
        return own_id, own_row, begin + first + start, begin + first + end

    texts: list[bytes] = []
    owners: list[tuple] = []
    size = 0

    def compared() -> Iterator[tuple]:
        for place, starts in zip(owners, repeated_starts(texts, least), strict=True):
            if place is not None:
                for start, end in _merged([(s, s + least) for s in starts.tolist()]):
                    yield at(place, start, end)

    for group in groups:
        for parts in _alike_parts(group, least):
            for part, places in parts.items():
                if len(places) > 1:
                    yield from (at((group, place), 0, len(part)) for place in places)
                if len(parts) > 1:
                    texts.append(part)
                    owners.append((group, places[0]) if len(places) == 1 else None)
                    size += len(part) + 1
            if size >= BYTES_TOGETHER:
                yield from compared()
                texts, owners, size = [], [], 0
    if texts:
        yield from compared()


def _compared(least: int, schema: pa.Schema):
    """Reads pieces sorted by ``core``; the pieces of one may span batches."""

    def emit(groups: list[list[tuple]]) -> pa.RecordBatch:
        columns = list(zip(*_spans_of(groups, least), strict=True)) or [()] * len(schema)
        arrays = [pa.array(values, kind.type) for values, kind in zip(columns, schema, strict=True)]
        return pa.record_batch(arrays, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, size, core = [], 0, None
        for batch in batches:
            names = ("core", "id", "row", "start", "anchor", "content")
            for row in zip(*[batch.column(n).to_pylist() for n in names], strict=True):
                if not groups or row[0] != core:
                    if size >= 4 * BYTES_TOGETHER:
                        yield emit(groups)
                        groups, size = [], 0
                    groups.append([])
                    core = row[0]
                groups[-1].append(row)
                size += len(row[-1])
        if groups:
            yield emit(groups)

    return run


def _marked(pieces: DataFrame) -> DataFrame:
    """The pieces that share their core with others: how often each occurs (``n``),
    whether it is to be compared, and whether its anchor is crowded, stored.

    Where rows meet by a key that very many may share, both sides are stored tables,
    since AQE splits a heavy partition only between plain shuffles. No list of cores
    is broadcast, so what is shuffled grows with the input alone.
    """
    common, common_path = store(
        pieces.groupBy("core").agg(F.count(F.lit(1)).alias("total")).filter("total > 1"),
        "common",
    )
    alive, alive_path = store(
        pieces.join(common.select("core").hint("merge"), "core", "left_semi"), "alive"
    )
    groups, groups_path = store(
        alive.groupBy(*_HASHES).agg(
            F.count(F.lit(1)).alias("n"), F.min("piece").alias("first")
        ),
        "groups",
    )
    cores, cores_path = store(
        groups.groupBy("core").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least")),
        "cores",
    )
    # Pieces that all occur twice have nothing left to find.
    shared, shared_path = store(
        groups.join(cores.hint("merge"), "core").select(
            *_HASHES,
            "n",
            "first",
            ((F.col("kinds") > 1) & (F.col("least") == 1)).alias("open"),
            (F.col("kinds") > PIECES_TOGETHER).alias("crowded"),
        ),
        "shared",
    )
    met = alive.join(shared.hint("merge"), list(_HASHES))
    compared = F.col("open") & (F.col("piece") == F.col("first"))
    marked = stored(
        met.select(*_PLACE, "core", "n", compared.alias("compared"), "crowded").filter(
            (F.col("n") > 1) | F.col("compared")
        ),
        "marked",
    )
    for path in (common_path, alive_path, groups_path, cores_path, shared_path):
        drop_folder(pieces.sparkSession, path)
    return marked


def _same_row(docs: DataFrame, others: DataFrame) -> Column:
    return (docs["row"] == others["own_row"]) & docs["id"].eqNullSafe(others["own_id"])


def _contents(docs: DataFrame, pieces: DataFrame, least: int) -> DataFrame:
    """The pieces with their bytes."""
    by_row = pieces.groupBy(F.col("id").alias("own_id"), F.col("row").alias("own_row")).agg(
        F.collect_list(F.struct("core", "start", "windows", "anchor")).alias("pieces")
    )
    lists = broadcast_if_small(stored(by_row, "lists"))
    raw = F.encode("text", "UTF-8")
    return (
        docs.join(lists, _same_row(docs, lists))
        .select("id", "row", raw.alias("bytes"), F.explode("pieces").alias("piece"))
        .select(
            "id",
            "row",
            "piece.core",
            "piece.start",
            "piece.anchor",
            F.substring(
                "bytes", F.col("piece.start") + 1, F.col("piece.windows") + (least - 1)
            ).alias("content"),
        )
    )


def repeated_spans(docs: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """``id``, ``row``, ``start`` and ``end`` of byte spans that consist of strings
    that start elsewhere too. They may overlap.

    ``docs`` has ``id``, ``row`` and ``text``; ``id`` and ``row`` together are the
    same for rows of the same text only.
    """
    equip(docs.sparkSession)
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    schema = _piece_schema(docs)
    arrow = to_arrow_schema(schema)
    spans = T.StructType([schema["id"], *[T.StructField(n, T.LongType()) for n in ("row", "start", "end")]])
    found = []
    pieces = docs.select("id", "row", "text").mapInArrow(_pieces(least_bytes, arrow), schema)
    for step in (*FINER, None):
        numbered, path = store(
            pieces.withColumn("piece", F.monotonically_increasing_id()), "pieces"
        )
        marked = _marked(numbered)
        drop_folder(docs.sparkSession, path)
        end = F.col("start") + F.col("windows") + (least_bytes - 1)
        found.append(marked.filter("n > 1").select("id", "row", "start", end.alias("end")))
        together = _contents(docs, marked.filter("compared AND NOT crowded"), least_bytes)
        found.append(
            together.select("core", "id", "row", "start", "anchor", "content")
            .repartition("core")
            .sortWithinPartitions("core")
            .mapInArrow(_compared(least_bytes, to_arrow_schema(spans)), spans)
        )
        crowded = marked.filter("compared AND crowded")
        if step is None or crowded.isEmpty():
            break
        pieces = _contents(docs, crowded, least_bytes).mapInArrow(
            _finer_pieces(least_bytes, step, arrow), schema
        )
    return functools.reduce(DataFrame.union, found)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The spans of each row as spans that do not touch."""
    for batch in batches:
        spans = batch.column("spans")
        rows = np.repeat(np.arange(len(spans)), spans.value_lengths())
        starts, ends = (part.to_numpy() for part in spans.flatten().flatten())
        # The row in the upper half: places of one row are below those of the next.
        starts, ends = (rows << 32) + starts, (rows << 32) + ends
        order = np.argsort(starts)
        starts, ends = starts[order], np.maximum.accumulate(ends[order])
        first = np.flatnonzero(starts > np.concatenate([[-1], ends[:-1]]))
        last = np.append(first[1:], len(starts)) - 1 if len(first) else first
        counts = np.bincount(starts[first] >> 32, minlength=len(spans))
        places = [pa.array(p & (2**32 - 1)) for p in (starts[first], ends[last])]
        kind = spans.type
        merged = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()),
            pa.StructArray.from_arrays(places, fields=list(kind.value_type)),
            type=kind,
        )
        columns = [batch.column("own_id"), batch.column("own_row"), merged]
        yield pa.record_batch(columns, schema=batch.schema)


def _cut(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _in_parts(batches):
            rows = []
            columns = (batch.column("text").cast(pa.binary()), batch.column("spans"))
            for text, spans in zip(*columns, strict=True):
                content = text.as_py() or b""
                merged = [(s["start"], s["end"]) for s in spans.as_py() or ()]
                edges = [0, *[edge for span in merged for edge in span], len(content)]
                kept = [content[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)]
                shown = [{"start": a, "end": b} for a, b in merged]
                rows.append((len(content), b"".join(kept), shown))
            columns = list(zip(*rows, strict=True)) or [(), (), ()]
            arrays = [batch.column("id")]
            arrays += [pa.array(v, f.type) for v, f in zip(columns, list(schema)[1:], strict=True)]
            yield pa.record_batch(arrays, schema=schema)

    return run


def remove_repeated_bytes(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_bytes: int = LEAST_BYTES,
) -> DataFrame:
    """Each row's ``id``, ``n_bytes`` of its text in UTF-8, the bytes ``kept``, and
    the ``spans`` removed, an array of ``start`` and ``end`` that do not touch.

    A byte goes if a string of ``least_bytes`` bytes covers it that starts at
    another place too, in the same text or another, also at an overlap; all
    occurrences go, the first included. What is left may begin or end within a
    character, so it is bytes. NULL counts as an empty text. Repeated rows, also
    with equal or NULL ids, are texts of their own, and so all repeated. An empty
    table gives no rows.

    Shuffled are hashes and places of the pieces, one for about every 3 / 8 of
    ``least_bytes``, the bytes of pieces that are compared, and the documents that
    hold those or lose something, if they are too many to be told by broadcast.
    The session hands rows to Python in batches of ``BATCH_BYTES`` from then on.
    Equal pieces are counted in map tasks first, and what shares an anchor is
    compared by ``PIECES_TOGETHER`` different pieces at most, so neither many
    copies nor a passage in very many texts is a heavy group. Pieces are equal by
    a 128-bit hash.
    """
    if least_bytes < 2 * FINER[0]:
        raise ValueError(f"strings of under {2 * FINER[0]} bytes are not looked for")
    keyed = docs.select(
        F.col(id_column).alias("id"),
        F.xxhash64(id_column, text_column).alias("row"),
        F.col(text_column).alias("text"),
    )
    spans = (
        repeated_spans(keyed, least_bytes)
        .groupBy(F.col("id").alias("own_id"), F.col("row").alias("own_row"))
        .agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    )
    merged = spans.mapInArrow(_merge, spans.schema)
    lists = broadcast_if_small(stored(merged, "spans"))
    schema = T.StructType(
        [
            keyed.schema["id"],
            T.StructField("n_bytes", T.LongType()),
            T.StructField("kept", T.BinaryType()),
            T.StructField("spans", lists.schema["spans"].dataType),
        ]
    )
    met = keyed.join(lists, _same_row(keyed, lists), "left").select("id", "text", "spans")
    return met.mapInArrow(_cut(to_arrow_schema(schema)), schema)
