"""Near copies by SimHash: links at few differing bits, found by deletion variants.

A fingerprint has 64 bits. Two that differ in at most three bits, cut into two
segments of 32, have a segment that differs in at most one bit. So each
fingerprint is indexed under each segment with each one of its bits blotted out:
64 signatures, and two linked fingerprints share one of them at least. Rows meet
by equality of the signature; the whole fingerprints are then compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larderline.llm.common import equip, stored
from larderline.llm.components import least_reachable

SHINGLE_WORDS = 3
HASH_SEED = 42
MOST_BITS = 3
SEGMENT_BITS = 32

# Members of a signature that are compared in one go. More are cut into blocks,
# and each pair of blocks is compared on its own.
BLOCK = 8192
# Shingle hashes whose bits are counted at a time.
HASHES_AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The SimHash of a text's word shingles as an unsigned number.

    A text of fewer words is one shingle; one without words has fingerprint 0.
    Only A-Z are lower-cased, and only ASCII blanks separate words.
    """
    # Of bytes, lower() and split() know ASCII only.
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    join, digest = b" ".join, xxhash.xxh64_intdigest
    ends = range(shingle_words, max(len(words), shingle_words) + 1)
    counts = np.zeros(64, dtype=np.int64)
    for first in range(0, len(ends), HASHES_AT_ONCE):
        hashes = np.fromiter(
            (
                digest(join(words[end - shingle_words : end]), HASH_SEED)
                for end in ends[first : first + HASHES_AT_ONCE]
            ),
            dtype="<u8",
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * counts > len(ends), bitorder="little")
    return int(majority.view("<u8")[0])


def _fingerprints(shingle_words: int):
    def of(texts: pd.Series) -> pd.Series:
        unsigned = [fingerprint(text, shingle_words) for text in texts]
        return pd.Series(np.array(unsigned, dtype=np.uint64).view(np.int64))

    return F.pandas_udf(of, T.LongType())


def signatures(fingerprints: DataFrame) -> DataFrame:
    """Each distinct ``fingerprint`` with its 64 signatures: the number of the
    bit that is blotted out, in front of the rest of that bit's segment."""
    bit = F.col("bit")
    half = F.lit(2**SEGMENT_BITS - 1)
    upper = F.shiftright("fingerprint", SEGMENT_BITS).bitwiseAND(half)
    lower = F.col("fingerprint").bitwiseAND(half)
    segment = F.when(bit < SEGMENT_BITS, lower).otherwise(upper)
    blot = F.expr(f"shiftleft(1L, bit % {SEGMENT_BITS})")
    rest = segment.bitwiseAND(F.bitwise_not(blot))
    bits = F.sequence(F.lit(0), F.lit(2 * SEGMENT_BITS - 1))
    number = F.expr(f"shiftleft(CAST(bit AS BIGINT), {SEGMENT_BITS})")
    return fingerprints.withColumn("bit", F.explode(bits)).select(
        number.bitwiseOR(rest).alias("signature"), "fingerprint"
    )


def _in_cells(signed: DataFrame, block: int) -> DataFrame:
    """Deal the members of a crowded signature out: each goes to one block, and
    each pair of blocks is a cell. Any two members meet in a cell."""
    crowded = stored(
        signed.groupBy("signature").count().filter(F.col("count") > block)
        .select("signature", F.ceil(F.col("count") / block).alias("blocks")),
        "crowded",
    )
    if crowded.isEmpty():
        return signed.withColumn("cell", F.lit(0).cast("long"))
    blocks = F.coalesce("blocks", F.lit(1).cast("long"))
    own = F.pmod(F.xxhash64("fingerprint"), blocks)
    return (
        signed.join(crowded, "signature", "left")
        .withColumns({"blocks": blocks, "own": own})
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumn("cell", F.least("own", "other") * F.col("blocks") + F.greatest("own", "other"))
        .select("signature", "fingerprint", "cell")
    )


def _spanning_links(members: np.ndarray, most_bits: int) -> list[tuple[int, int]]:
    """Links that connect what is connected within the members, one per member
    at most. Each round compares one reached member with all unreached ones."""
    links = []
    unreached = members
    while len(unreached) > 1:
        frontier, unreached = [unreached[0]], unreached[1:]
        while frontier and len(unreached):
            here = frontier.pop()
            near = np.bitwise_count(unreached ^ here) <= most_bits
            found, unreached = unreached[near], unreached[~near]
            frontier.extend(found)
            links.extend((int(here), int(there)) for there in found)
    return links


def _links_of_cells(most_bits: int):
    """Reads rows sorted by signature and cell; a cell may span batches."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def emit(links):
        columns = np.array(links, dtype=np.uint64).reshape(-1, 2).view(np.int64)
        return pa.record_batch([pa.array(columns[:, 0]), pa.array(columns[:, 1])], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.empty((0, 3), dtype=np.int64)
        for batch in batches:
            columns = ("signature", "cell", "fingerprint")
            rows = np.column_stack([batch.column(name).to_numpy() for name in columns])
            kept, links = _finished_cells(np.concatenate([kept, rows]), most_bits, last=False)
            yield emit(links)
        _, links = _finished_cells(kept, most_bits, last=True)
        yield emit(links)

    return run


def _finished_cells(rows: np.ndarray, most_bits: int, last: bool):
    """The rows of the last cell, which may go on, and the links of all others."""
    if not len(rows):
        return rows, []
    starts = np.flatnonzero(np.any(rows[1:, :2] != rows[:-1, :2], axis=1)) + 1
    bounds = np.concatenate([[0], starts, [len(rows)]])
    if not last:
        bounds = bounds[:-1]
    links = []
    for at in np.flatnonzero(np.diff(bounds) > 1):
        members = np.ascontiguousarray(rows[bounds[at] : bounds[at + 1], 2]).view(np.uint64)
        links.extend(_spanning_links(members, most_bits))
    return rows[bounds[-1] :], links


def near_links(
    fingerprints: DataFrame, most_bits: int = MOST_BITS, block: int = BLOCK
) -> DataFrame:
    """Links ``a``, ``b`` between distinct fingerprints, enough of them that any
    two at most ``most_bits`` bits apart are connected."""
    if not 0 <= most_bits <= 3:
        raise ValueError("two segments find up to 3 differing bits")
    equip(fingerprints.sparkSession)
    cells = _in_cells(signatures(fingerprints), block)
    dealt = cells.repartition("signature", "cell").sortWithinPartitions("signature", "cell")
    return dealt.mapInArrow(_links_of_cells(most_bits), "a long, b long").distinct()


def near_copies(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    most_bits: int = MOST_BITS,
    carry: bool = False,
    block: int = BLOCK,
) -> DataFrame:
    """Each row with its fingerprint and the group of near copies it belongs to.

    Returns ``id``, ``fingerprint`` (a signed 64-bit number), ``component`` (the
    smallest id of the group; NULL only if none has an id), ``stays`` (true for
    one row of each group, the one with the smallest id), and with ``carry`` the
    whole row as the struct ``document``.

    NULL and empty texts have fingerprint 0 and are linked like any other.
    Repeated rows, also with equal ids, are members of one group, of which one
    row stays. A NULL id counts as largest. An empty table gives no rows.
    """
    equip(docs.sparkSession)
    document = [F.struct(*docs.columns).alias("document")] if carry else []
    printed = stored(
        docs.select(
            F.col(id_column).alias("id"),
            _fingerprints(shingle_words)(text_column).alias("fingerprint"),
            F.monotonically_increasing_id().alias("row"),
            *document,
        ),
        "fingerprints",
    )
    first = F.min(F.struct(F.col("id").isNull().alias("unknown"), "id", "row")).alias("first")
    distinct = stored(printed.groupBy("fingerprint").agg(first), "distinct")
    links = near_links(distinct.select("fingerprint"), most_bits, block)
    hung = least_reachable(links)
    rooted = distinct.join(hung, distinct.fingerprint == hung.node, "left").select(
        "fingerprint", "first", F.coalesce("least", "fingerprint").alias("root")
    )
    # Only roots that something hangs on have more than one fingerprint.
    firsts = rooted.groupBy("root").agg(F.min("first").alias("first"))
    grouped = stored(rooted.drop("first").join(firsts, "root").drop("root"), "groups")
    return (
        printed.join(grouped, "fingerprint")
        .withColumn("component", F.col("first.id"))
        .withColumn("stays", F.col("row") == F.col("first.row"))
        .drop("first", "row")
    )


def drop_near_copies(docs: DataFrame, **options) -> DataFrame:
    """The documents with one of each group of near copies, whole rows."""
    marked = near_copies(docs, carry=True, **options)
    return marked.filter("stays").select("document.*")
