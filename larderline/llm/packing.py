"""Pack tokenized documents into sequences of a fixed number of tokens.

Documents are tokenized, ended by a separator and, only if they are too long,
cut. How many pieces have which length is all the plan depends on, and there are
no more lengths than tokens in a sequence; so the plan is made on that histogram,
whatever the number of documents. Pieces above a third of the capacity go at most
two to a sequence and are paired greedily: the longest with the longest that
still fits. Shorter pieces, longest first, go where the least room is left.
Spark then numbers the pieces of each length and looks their place up.
"""

from __future__ import annotations

import functools
import json
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from larderline.llm.common import equip, stored

CAPACITY = 1024
SEPARATOR = 2
# Pieces of a length that are numbered together, about.
NUMBERED_AT_ONCE = 5_000

# Fixed value: how byte-level vocabularies of this kind split a text first.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of_character() -> dict[str, int]:
    """Vocabulary files write a byte as a visible character: itself if it is
    one, else the next free one from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [byte for byte in range(256) if byte not in visible]
    shown = {chr(byte): byte for byte in visible}
    return shown | {chr(256 + at): byte for at, byte in enumerate(rest)}


@functools.cache
def _tokenizer(vocabulary: str) -> Tokenizer:
    return Tokenizer.from_file(vocabulary)


def _is_of_this_kind(content: dict) -> bool:
    """Whether a file's tokens are merged bytes, in the order of their ids, of texts
    split as above."""
    split, model = content["pre_tokenizer"] or {}, content["model"]
    plain = (
        content["normalizer"] is None
        and split.get("type") == "ByteLevel"
        and split.get("use_regex", True)
        and not split.get("add_prefix_space")
        and model.get("type") == "BPE"
        and not any(model.get(name) for name in ("dropout", "ignore_merges", "byte_fallback"))
        and not model.get("continuing_subword_prefix")
        and not model.get("end_of_word_suffix")
    )
    if not plain:
        return False
    pairs = (pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"])
    ids = [model["vocab"]["".join(pair)] for pair in pairs]
    return ids == sorted(ids)


@functools.cache
def _encoder(vocabulary: str):
    """Text to token ids by a byte-level vocabulary file of `tokenizers`.

    The ids are those that `tokenizers` gives. They are worked out by `tiktoken`
    from the ids in the same file, which is several times as fast; a text that
    holds a special token's string goes through `tokenizers` itself, and so do all
    texts if the file is of another kind.
    """
    with open(vocabulary, encoding="utf-8") as file:
        content = json.load(file)
    if not _is_of_this_kind(content):
        return lambda text: _tokenizer(vocabulary).encode(text, add_special_tokens=False).ids
    byte_of = _byte_of_character()
    special = [token["content"] for token in content["added_tokens"]]
    ranks = {
        bytes(byte_of[character] for character in token): number
        for token, number in content["model"]["vocab"].items()
        if token not in special
    }
    fast = tiktoken.Encoding("vocabulary", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        if any(token in text for token in special):
            return _tokenizer(vocabulary).encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


def cut(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """Start and length of the pieces; only the first may be shorter."""
    first = length % capacity or min(length, capacity)
    return [(0, first)] + [(start, capacity) for start in range(first, length, capacity)]


def _pieces(vocabulary: str, capacity: int, separator: int, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(vocabulary)
        for batch in batches:
            rows, pieces, starts, lengths, ids = [], [], [], [], []
            for row, text in enumerate(batch.column("text")):
                tokens = np.array(encode(text.as_py() or "") + [separator], dtype="<u4")
                for piece, (start, length) in enumerate(cut(len(tokens), capacity)):
                    rows.append(row)
                    pieces.append(piece)
                    starts.append(start)
                    lengths.append(length)
                    ids.append(tokens[start : start + length].tobytes())
            taken = batch.select(columns).take(pa.array(rows, pa.int64()))
            numbers = [pa.array(values, pa.int64()) for values in (pieces, starts, lengths)]
            yield pa.record_batch(
                [*taken.columns, *numbers, pa.array(ids, pa.binary())],
                names=[*columns, "piece", "start", "length", "ids"],
            )

    return run


def tokenized(
    docs: DataFrame,
    vocabulary: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = CAPACITY,
    separator: int = SEPARATOR,
) -> DataFrame:
    """The pieces of each document: ``id``, ``piece`` from 0, ``start`` and
    ``length`` in tokens, ``ids``, little-endian unsigned 32-bit numbers, and
    ``row``, a number that no other piece has. It holds for the stored pieces only.

    NULL and empty texts are one piece, the separator. The file has to be where
    each executor finds it.
    """
    equip(docs.sparkSession)
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    added = [T.StructField(name, T.LongType()) for name in ("piece", "start", "length")]
    schema = T.StructType([texts.schema["id"], *added, T.StructField("ids", T.BinaryType())])
    pieces = texts.mapInArrow(_pieces(vocabulary, capacity, separator, ["id"]), schema)
    return pieces.withColumn("row", F.monotonically_increasing_id())


class _Bins:
    """Sequences by the room they have left: contents, and how many are alike."""

    def __init__(self):
        self.by_room: dict[int, Counter] = defaultdict(Counter)

    def add(self, contents: tuple, room: int, count: int) -> None:
        self.by_room[room][contents] += count

    def take(self, room: int, count: int) -> Iterator[tuple[tuple, int]]:
        """So many sequences of this room, by contents."""
        alike = self.by_room[room]
        while count and alike:
            contents = next(iter(alike))
            taken = min(count, alike[contents])
            alike[contents] -= taken
            if not alike[contents]:
                del alike[contents]
            count -= taken
            yield contents, taken
        if not alike:
            del self.by_room[room]


def _pair_large(large: dict[int, int], capacity: int, bins: _Bins) -> None:
    """The longest piece meets the longest other one that fits, if any does."""
    left = dict(large)
    for length in sorted(large, reverse=True):
        for partner in range(min(length, capacity - length), 0, -1):
            if not left.get(length):
                break
            if left.get(partner):
                pairs = left[length] // 2 if partner == length else min(left[length], left[partner])
                if pairs:
                    left[length] -= pairs
                    left[partner] -= pairs
                    contents = ((length, 2),) if partner == length else ((length, 1), (partner, 1))
                    bins.add(contents, capacity - length - partner, pairs)
        if left.get(length):
            bins.add(((length, 1),), capacity - length, left.pop(length))


def _fit_small(length: int, count: int, capacity: int, bins: _Bins) -> None:
    """Fill up the least room that takes the piece, as often as it takes it."""
    while count:
        room = min((room for room in bins.by_room if room >= length), default=capacity)
        if room == capacity and capacity not in bins.by_room:
            bins.add((), capacity, -(-count // (capacity // length)))
        each = min(room // length, count)
        sequences = min(count // each, sum(bins.by_room[room].values()))
        for contents, taken in list(bins.take(room, sequences)):
            bins.add((*contents, (length, each)), room - each * length, taken)
        count -= each * sequences


def plan(lengths: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple, int]]:
    """Contents of sequences, as lengths and how many of each, and their number.

    ``lengths`` says how many pieces have which length.
    """
    bins = _Bins()
    large = {length: count for length, count in lengths.items() if 3 * length > capacity}
    _pair_large(large, capacity, bins)
    for length in sorted(set(lengths) - set(large), reverse=True):
        _fit_small(length, lengths[length], capacity, bins)
    filled = [item for alike in bins.by_room.values() for item in alike.items()]
    return sorted((item for item in filled if item[0]), reverse=True)


def slots(planned: list[tuple[tuple, int]]) -> list[tuple]:
    """Where the pieces of a length go, by their rank among them: rows of length,
    first and last rank, first sequence, offset, and pieces in each sequence."""
    ranks: Counter = Counter()
    rows, sequence = [], 0
    for contents, count in planned:
        offset = 0
        for length, each in contents:
            first = ranks[length]
            ranks[length] += each * count
            rows.append((length, first, ranks[length] - 1, sequence, offset, each))
            offset += length * each
        sequence += count
    return rows


def in_shares(pieces: DataFrame, lengths: dict[int, int]) -> DataFrame:
    """Stored pieces with the ``share`` of their length that they are numbered in.

    Shares are dealt by the number of the piece, so pieces equal in all else, or
    without id, spread as well.
    """
    split = [(length, 1 + n // NUMBERED_AT_ONCE) for length, n in lengths.items()]
    shares = F.broadcast(pieces.sparkSession.createDataFrame(split, "length long, shares long"))
    share = F.pmod(F.xxhash64("row"), F.col("shares")).alias("share")
    return pieces.join(shares, "length").select(*pieces.columns, share)


def placed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Stored pieces with ``sequence_id`` and the ``offset`` in the sequence.

    The histogram of lengths has ``capacity`` rows at most, and so few rows have
    the tables that are broadcast: each length meets each kind of contents once.
    A length that a third of all pieces have is numbered ``in_shares``; there are
    as many as keep one small. Which of the pieces of a length goes where depends
    on how they are stored.
    """
    spark = pieces.sparkSession
    by_length = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).toArrow().to_pylist()
    lengths = {row["length"]: row["n"] for row in by_length}
    shared = in_shares(pieces, lengths)
    counts = stored(shared.groupBy("length", "share").agg(F.count(F.lit(1)).alias("n")), "lengths")
    rows = slots(plan(lengths, capacity))
    names = ("length", "first_rank", "last_rank", "first_sequence", "at", "each")
    schema = ", ".join(f"{name} long" for name in names)
    places = F.broadcast(spark.createDataFrame(rows, schema))

    before = Window.partitionBy("length").orderBy("share")
    earlier = counts.withColumn("earlier", F.sum("n").over(before) - F.col("n")).drop("n")
    among = Window.partitionBy("length", "share").orderBy("row")
    ranked = (
        shared.withColumn("own", F.row_number().over(among) - 1)
        .join(earlier, ["length", "share"])
        .withColumn("rank", F.col("earlier") + F.col("own"))
    )
    past = F.col("rank") - F.col("first_rank")
    return (
        ranked.join(places, "length")
        .filter(F.col("rank").between(F.col("first_rank"), F.col("last_rank")))
        .withColumn("sequence_id", F.col("first_sequence") + F.floor(past / F.col("each")))
        .withColumn("offset", F.col("at") + F.col("length") * (past % F.col("each")))
        .select(*pieces.columns, "sequence_id", "offset")
        .drop("row")
    )


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, **options) -> DataFrame:
    """``tokenized`` pieces with their ids, ``placed`` in sequences.

    Repeated rows are packed as often as they occur. An empty table needs no
    sequence and gives no rows.
    """
    pieces = stored(tokenized(docs, vocabulary, capacity=capacity, **options), "pieces")
    return placed(pieces, capacity)
