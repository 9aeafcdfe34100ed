"""Find benchmark items inside documents by size-partitioned MinHash containment.

An item is contained in a document if the document has most of its five-word
shingles. A MinHash of fixed length would lose a short item in a long document,
so sketches are partitioned by size on both sides. Hash values are cut into as
many bins as the size class of the document calls for, and the sketch keeps the
least hash of each bin (a one-permutation MinHash). How many shingles share a bin
depends on the size class of the item: long items are found by few of their
shingles, short ones need a bin for each. An item whose shingles are the least
of a bin of the document is a candidate; its containment is then worked out on
the shingles themselves.

The items are the stated queries, cut into blocks of bounded size; each block is
broadcast and held against all documents, which are not shuffled.
"""

from __future__ import annotations

import functools
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larderline.llm.common import broadcast_if_small, equip, stored

SHINGLE_WORDS = 5
CONTAINMENT = 0.8
# Chance that a contained item shares no sketch value, at most.
MISS = 1e-9
# Characters of items in a block.
BLOCK_CHARS = 16_000_000

_WORD = re.compile(r"\w+")
# Scripts that leave no blanks between words: Thai, Lao, Myanmar, Khmer, kana, Han.
_UNSPACED = (
    "\u0e01-\u0e4e\u0e81-\u0ece\u1000-\u109f\u1780-\u17d3\u3005\u3007\u3041-\u3096\u30a1-\u30fa"
    "\u30fc\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
)
_HAS_UNSPACED = re.compile(f"[{_UNSPACED}]")
_WORD_OR_CHARACTER = re.compile(rf"[{_UNSPACED}]|[^\W{_UNSPACED}]+")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_CACHED_WORDS = 1 << 20


class _WordHashes(dict):
    """Word to hash, worked out once; emptied when it grows too large."""

    def __missing__(self, word: str) -> int:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


def words_of(text: str | None) -> list[str]:
    """Runs of letters, digits and underscores, lower-cased. A character of a
    script without blanks is a word of its own."""
    lowered = (text or "").lower()
    if lowered.isascii() or not _HAS_UNSPACED.search(lowered):
        return _WORD.findall(lowered)
    return _WORD_OR_CHARACTER.findall(lowered)


def shingle_hashes(
    words: list[str], known: dict[str, int], size: int = SHINGLE_WORDS
) -> np.ndarray:
    """A hash for each place where a shingle starts."""
    of_words = np.fromiter((known[word] for word in words), dtype=np.uint64, count=len(words))
    places = len(words) - size + 1
    if places < 1:
        return of_words[:0]
    mixed = np.zeros(places, dtype=np.uint64)
    for offset in range(size):
        mixed = mixed * _FACTOR + of_words[offset : offset + places]
        mixed ^= mixed >> np.uint64(29)
    mixed *= _FACTOR
    return mixed ^ (mixed >> np.uint64(32))


def size_class(size: int) -> int:
    """The power of two that is not below the size, by its exponent."""
    return max(0, int(size - 1).bit_length())


def bins_per_shingle(least_shared: int) -> int:
    """Bins for each shingle of a document, as an exponent, such that one of so
    many shared shingles is the least of its bin but for a chance of MISS.

    With ``load`` shingles a bin, one of them is the least with probability
    (1 - exp(-load)) / load.
    """
    exponent = 64
    for candidate in range(8, -64, -1):
        load = 2.0**-candidate
        least = -np.expm1(-load) / load
        if least < 1 and least_shared * np.log1p(-least) > np.log(MISS):
            break
        exponent = candidate
    return exponent


class ItemIndex:
    """A block of items, by size class: sorted shingle hashes and who has them.

    An item of fewer words than a shingle is one shingle of all its words. They
    are kept by their number of words; there is nothing to sketch.
    """

    def __init__(self, texts: list[str | None], containment: float):
        self.words = [words_of(text) for text in texts]
        self.containment = containment
        known = _WordHashes()
        self.hashes = [np.unique(shingle_hashes(words, known)) for words in self.words]
        self.short: dict[int, dict[int, list[int]]] = {}
        members = defaultdict(list)
        for number, hashes in enumerate(self.hashes):
            size = len(self.words[number])
            if 0 < size < SHINGLE_WORDS:
                (only,) = shingle_hashes(self.words[number], known, size).tolist()
                self.short.setdefault(size, {}).setdefault(only, []).append(number)
            if len(hashes):
                members[size_class(len(hashes))].append(number)
        self.classes = []
        for numbers in members.values():
            least = min(len(self.hashes[number]) for number in numbers)
            keys = np.concatenate([self.hashes[number] for number in numbers])
            owners = np.repeat(numbers, [len(self.hashes[number]) for number in numbers])
            order = np.argsort(keys, kind="stable")
            exponent = bins_per_shingle(int(np.ceil(containment * least)))
            self.classes.append((exponent, keys[order], owners[order]))

    def candidates(self, hashes: np.ndarray) -> np.ndarray:
        """Items that share a sketch value with the document of these distinct
        sorted shingle hashes."""
        found = []
        for exponent, keys, owners in self.classes:
            bits = min(64, max(0, size_class(len(hashes)) + exponent))
            bins = hashes >> np.uint64(64 - bits) if bits else np.zeros_like(hashes)
            least = np.concatenate([[True], bins[1:] != bins[:-1]])
            sketch = hashes[least]
            first = np.searchsorted(keys, sketch, "left")
            last = np.searchsorted(keys, sketch, "right")
            for at in np.flatnonzero(last > first):
                found.append(owners[first[at] : last[at]])
        return np.unique(np.concatenate(found)) if found else np.empty(0, dtype=np.int64)

    def short_ones(self, words: list[str], known: dict[str, int]) -> list[int]:
        """The items of few words that stand in a text of these words."""
        found = []
        for size, owners in self.short.items():
            places = shingle_hashes(words, known, size)
            keys = np.fromiter(owners, dtype=np.uint64, count=len(owners))
            starts = np.flatnonzero(np.isin(places, keys))
            here = {tuple(words[at : at + size]) for at in starts.tolist()}
            hit = {number for key in places[starts].tolist() for number in owners[key]}
            found += [number for number in hit if tuple(self.words[number]) in here]
        return sorted(found)

    def contained(self, text: str | None, known: dict[str, int]) -> list[tuple[int, int, int]]:
        """Number, shingles and shared shingles of each contained item."""
        words = words_of(text)
        found = [(number, 1, 1) for number in self.short_ones(words, known)]
        places = shingle_hashes(words, known)
        if not len(places):
            return found
        hashes = np.unique(places)
        for number in self.candidates(hashes):
            own = self.hashes[number]
            if np.isin(own, hashes).sum() < self.containment * len(own):
                continue
            starts = np.flatnonzero(np.isin(places, own))
            here = {tuple(words[at : at + SHINGLE_WORDS]) for at in starts}
            item = self.words[number]
            wanted = {
                tuple(item[at : at + SHINGLE_WORDS]) for at in range(len(item) - SHINGLE_WORDS + 1)
            }
            shared = len(wanted & here)
            if shared >= self.containment * len(wanted):
                found.append((int(number), len(wanted), shared))
        return found


def _search(index, item_ids):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        for batch in batches:
            rows, numbers, sizes, shared = [], [], [], []
            for row, text in enumerate(batch.column("text")):
                for number, size, both in index.value.contained(text.as_py(), known):
                    rows.append(row)
                    numbers.append(number)
                    sizes.append(size)
                    shared.append(both)
            rows = pa.array(rows, pa.int64())
            yield pa.record_batch(
                [
                    batch.column("id").take(rows),
                    batch.column("row").take(rows),
                    item_ids.value.take(pa.array(numbers, pa.int64())),
                    pa.array(sizes, pa.int64()),
                    pa.array(shared, pa.int64()),
                ],
                names=["id", "row", "item_id", "n_shingles", "n_shared"],
            )

    return run


def not_searched(items: DataFrame, text_column: str = "text") -> DataFrame:
    """The items that ``contained_items`` does not search for: those without a
    word."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_column).to_pylist()
            none = [not words_of(text) for text in texts]
            yield batch.filter(pa.array(none, pa.bool_()))

    equip(items.sparkSession)
    return items.mapInArrow(of, items.schema)


def _keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(
        F.col(id_column).alias("id"),
        F.xxhash64(id_column, text_column).alias("row"),
        F.col(text_column).alias("text"),
    )


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id_column: str = "item_id",
    item_text_column: str = "text",
    containment: float = CONTAINMENT,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """A row for each document and item contained in it: ``id``, a hash ``row``
    of id and text, ``item_id``, ``n_shingles`` of the item, ``n_shared`` of them.

    Shingles are distinct runs of five words, compared without case and
    punctuation; in scripts without blanks they are runs of five characters. An
    item of fewer words is contained where all of them stand in a row, which a
    clean text may have by chance: leave such items out if that is not wanted.
    NULL and empty texts contain nothing and are contained nowhere. Repeated
    documents give repeated rows, equal rows of items count once; NULL ids stay
    NULL.
    """
    # What is left is different, so blocks cut by a hash of it are alike in size.
    texts = items.select(
        F.col(item_id_column).alias("item_id"), F.col(item_text_column).alias("text")
    ).distinct()
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = 1 + int(chars) // block_chars
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    keyed = _keyed(docs, id_column, text_column)
    schema = T.StructType(
        [keyed.schema["id"], keyed.schema["row"], texts.schema["item_id"]]
        + [T.StructField(name, T.LongType()) for name in ("n_shingles", "n_shared")]
    )
    equip(docs.sparkSession)
    context = docs.sparkSession.sparkContext
    found = []
    for number in range(blocks):
        # At most about block_chars characters.
        own = texts.filter(block == number).toArrow()
        index = context.broadcast(ItemIndex(own.column("text").to_pylist(), containment))
        ids = context.broadcast(own.column("item_id").combine_chunks())
        found.append(stored(keyed.mapInArrow(_search(index, ids), schema), "contained"))
        index.destroy()
        ids.destroy()
    return functools.reduce(DataFrame.union, found)


def drop_contaminated(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    **options,
) -> DataFrame:
    """The documents that contain no item, whole rows.

    The list of the others is broadcast if its counted rows allow it. Else both
    are shuffled by a hash of id and text, which no key is heavy in but copies
    with equal ids; AQE splits those.
    """
    found = contained_items(docs, items, id_column, text_column, **options)
    listed = found.select(F.col("id").alias("_id"), F.col("row").alias("_row")).distinct()
    dirty = broadcast_if_small(stored(listed, "contaminated"))
    same = (F.xxhash64(docs[id_column], docs[text_column]) == F.col("_row")) & docs[
        id_column
    ].eqNullSafe(F.col("_id"))
    return docs.join(dirty, same, "left_anti")
