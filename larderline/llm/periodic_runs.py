"""Stretches of a text that repeat themselves: its runs, by a suffix automaton.

A run is a stretch of words that repeats with some period at least twice and that
can not be extended. Words are appended one by one. Each prefix is a node of the
tree of suffix links, and the nodes on its path to the root are the strings that
end there. The path is accessed as in a link-cut tree: it falls into segments of
nodes that were last seen at one place, and is then coloured with the new place.
If a segment was last seen a distance back that is no more than the length of its
longest string, that string and its earlier copy touch or overlap: a square. The
longest string also tells where the run begins; the last square of a run, where
it ends. Tests compare with all stretches of small texts.

The tree is known before the colouring, so paths are kept by the heavy paths of
the tree: a stack of coloured segments for each, in place of splay trees.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from larderline.llm.common import equip, let, words

LEAST_WORDS = 12

# Words of a run lie in stretches of so many words that occur twice: a run has
# 2 periods and 12 words, so its first such stretch comes again a period later.
GRAM = LEAST_WORDS // 2
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _suffix_automaton(word_ids: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Longest string and suffix link of each node, and the node of each prefix."""
    longest, link, follow = [0], [-1], [{}]
    prefixes = []
    last = 0
    for at, word in enumerate(word_ids):
        node = len(longest)
        longest.append(at + 1)
        link.append(0)
        follow.append({})
        before = last
        while before != -1 and word not in follow[before]:
            follow[before][word] = node
            before = link[before]
        if before != -1:
            there = follow[before][word]
            if longest[there] != longest[before] + 1:
                split = len(longest)
                longest.append(longest[before] + 1)
                link.append(link[there])
                follow.append(follow[there].copy())
                link[there] = split
                while before != -1 and follow[before].get(word) == there:
                    follow[before][word] = split
                    before = link[before]
                there = split
            link[node] = there
        prefixes.append(node)
        last = node
    return longest, link, prefixes


def _heavy_heads(longest: list[int], link: list[int]) -> list[int]:
    """The first node of the heavy path that each node lies on."""
    order = np.argsort(longest, kind="stable")[1:].tolist()
    size = [1] * len(longest)
    heavy = [0] * len(longest)
    most = [0] * len(longest)
    for node in reversed(order):
        above, own = link[node], size[node]
        size[above] += own
        if own > most[above]:
            most[above], heavy[above] = own, node
    heads = list(range(len(longest)))
    for node in order:
        above = link[node]
        # The root is on no path: its string is empty.
        if above and heavy[above] == node:
            heads[node] = heads[above]
    return heads


def _squares(word_ids: list[int]) -> dict[tuple[int, int], int]:
    """Where each run's last square ends, by the run's start and period."""
    longest, link, prefixes = _suffix_automaton(word_ids)
    heads = _heavy_heads(longest, link)
    # Segments of a heavy path, the uppermost last: where they end, when last seen.
    segments: list[list[tuple[int, int]]] = [[] for _ in longest]
    ends = {}
    for place, node in enumerate(prefixes):
        newest = -1
        while node:
            head, length = heads[node], longest[node]
            path = segments[head]
            above = newest
            while path:
                bottom, seen = path[-1]
                reach = bottom if bottom < length else length
                # What was seen on a heavy path below was looked at there. Going
                # down this one, each segment was seen earlier than the one before.
                if seen > newest:
                    distance = place - seen
                    if distance <= reach:
                        ends[place + 1 - reach - distance, distance] = place
                    if seen > above:
                        above = seen
                if bottom > length:
                    break
                path.pop()
            path.append((length, place))
            newest = above
            node = link[head]
    return ends


def _stretches(hashes: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Stretches in which all runs lie: each word is part of some words in a row
    that occur twice in the stretch."""
    done, todo = [], [(0, len(hashes))]
    while todo:
        first, end = todo.pop()
        if end - first < least:
            continue
        grams = hashes[first : end - GRAM + 1].copy()
        for step in range(1, GRAM):
            grams *= _MIX
            grams += hashes[first + step : end - GRAM + 1 + step]
        ordered = np.argsort(grams)
        same = np.flatnonzero(grams[ordered[1:]] == grams[ordered[:-1]])
        if not len(same):
            continue
        changes = np.zeros(end - first + 1, dtype=np.int64)
        twice = np.zeros(len(grams), dtype=bool)
        twice[ordered[same]] = twice[ordered[same + 1]] = True
        starts = np.flatnonzero(twice)
        changes[starts] += 1
        changes[starts + GRAM] -= 1
        covered = np.cumsum(changes[:-1]) > 0
        edges = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]])))
        found = [(first + a, first + b) for a, b in zip(edges[::2], edges[1::2], strict=True)]
        if found == [(first, end)]:
            done.append((first, end))
        else:
            todo.extend(found)
    return done


def runs_of(tokens: list, least_words: int = LEAST_WORDS) -> list[tuple[int, int, int]]:
    """Start, length and smallest period of each run, in order.

    A run has ``least_words`` words and two periods, and no neighbouring word
    extends it. Only hashes of words are compared to leave out stretches without
    runs; runs are found by the words themselves.
    """
    if least_words < LEAST_WORDS:
        raise ValueError(f"runs of under {LEAST_WORDS} words are not looked for")
    if len(tokens) < least_words:
        return []
    hashes = np.fromiter(map(hash, tokens), dtype=np.int64, count=len(tokens)).view(np.uint64)
    found = []
    for first, end in _stretches(hashes, least_words):
        numbers: dict = {}
        ids = [numbers.setdefault(word, len(numbers)) for word in tokens[first:end]]
        found.extend(
            (int(first) + start, last + 1 - start, period)
            for (start, period), last in _squares(ids).items()
            if last + 1 - start >= least_words
        )
    return sorted(found, key=lambda run: (run[0], run[2]))


def _without_repeats(tokens: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run repeats: of each run, its first period stays."""
    if not runs:
        return tokens
    changes = np.zeros(len(tokens) + 1, dtype=np.int64)
    for start, length, period in runs:
        changes[start + period] += 1
        changes[start + length] -= 1
    kept = np.cumsum(changes[:-1]) == 0
    return [tokens[at] for at in np.flatnonzero(kept)]


_RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


def _documents(schema: pa.Schema, least_words: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                # Of bytes, split() knows ASCII blanks only.
                tokens = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                runs = runs_of(tokens, least_words)
                collapsed = b" ".join(_without_repeats(tokens, runs))
                shown = [{"start": s, "length": n, "period": p} for s, n, p in runs]
                text = collapsed.decode("utf-8", "surrogatepass") if with_text else None
                rows.append((shown, text, hashlib.sha256(collapsed).hexdigest()))
            columns = list(zip(*rows, strict=True)) or [(), (), ()]
            arrays = [batch.column("id")]
            arrays += [pa.array(v, f.type) for v, f in zip(columns, list(schema)[1:], strict=True)]
            yield pa.record_batch(arrays, schema=schema)

    return run


def find_runs(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_words: int = LEAST_WORDS,
    with_text: bool = True,
) -> DataFrame:
    """Each row's ``id``, its ``runs``, an array of ``start``, ``length`` and
    ``period`` in words by start and period, the text ``collapsed`` to what no run
    repeats, words joined by one space (NULL without ``with_text``), and its
    ``collapsed_sha256``.

    Words are what stands between ASCII blanks. A NULL or empty text has no runs
    and collapses to an empty one. Rows are independent of each other, so copies
    and NULL ids need no care; nothing is shuffled, and a task holds one batch.
    Time grows as n log n with the words of a text, whatever it repeats.
    """
    equip(docs.sparkSession)
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    schema = T.StructType(
        [
            texts.schema["id"],
            T.StructField("runs", T.ArrayType(_RUN)),
            T.StructField("collapsed", T.StringType()),
            T.StructField("collapsed_sha256", T.StringType()),
        ]
    )
    return texts.mapInArrow(_documents(to_arrow_schema(schema), least_words, with_text), schema)


def summary(found: DataFrame) -> DataFrame:
    """For each row of ``find_runs`` the number of runs, the longest one (of equal
    ones the first, then that of the smallest period), and a digest of all."""
    # The greatest by length, then by the negatives of start and period.
    longest = F.array_max(
        F.transform(
            "runs",
            lambda run: F.struct(
                run.length.alias("length"),
                (-run.start).alias("back"),
                (-run.period).alias("beat"),
            ),
        )
    )

    def line(run: Column) -> Column:
        parts = [run[name].cast("string") for name in ("start", "length", "period")]
        return F.concat(F.concat_ws(",", *parts), F.lit("\n"))

    return found.select(
        "id",
        F.size("runs").cast("long").alias("n_runs"),
        (-longest["back"]).alias("start"),
        longest["length"].alias("length"),
        (-longest["beat"]).alias("period"),
        F.floor(1000 * longest["length"] / -longest["beat"]).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        "collapsed_sha256",
    )


def planted(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows with a period planted in every tenth text, by a checksum of the id.

    Let h be the checksum of the decimal id, and g = h / 10, rounded down. If h is
    divisible by 10, the words from place a = g % n on become the p words from
    there, again and again, where p = 1 + (n - a) / (3 + g % 8), rounded down. A
    text without words stays, as does one with a NULL id.
    """
    h = F.crc32(F.col(id_column).cast("string"))
    g = F.floor(h / 10)

    def repeated(all_words: Column) -> Column:
        n = F.size(all_words)

        def from_place(a: Column) -> Column:
            p = 1 + F.floor((n - a) / (3 + g % 8))

            def by_period(period: Column) -> Column:
                return F.transform(
                    all_words,
                    lambda word, i: F.when(i < a, word).otherwise(
                        F.get(all_words, (a + (i - a) % period).cast("int"))
                    ),
                )

            return let(p, by_period)

        return let(g % n, from_place)

    text = F.when(
        h % 10 == 0,
        let(
            words(F.col(text_column)),
            lambda all_words: F.when(F.size(all_words) > 0, F.array_join(repeated(all_words), " ")),
        ),
    )
    return docs.withColumn(text_column, F.coalesce(text, F.col(text_column)))
