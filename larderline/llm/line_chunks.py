"""Remove passages of lines that other documents have already.

Whether a boundary lies between two lines is told by the lines alone: a rolling
hash over the hashes of both is looked up in all documents, and where no other
place has it, one chunk ends and another begins. So a passage that stands in many
documents is cut alike in each, wherever it begins and whatever its neighbours
are, and two lines are enough for a chunk. A line long enough to be a passage is
looked up on its own as well. Chunks of lines that stood elsewhere before are
removed, after the bytes of each two neighbours are compared with those of their
first occurrence, which stays. All of it is DataFrame code.

Here a line takes the blank ones after it along, so blank lines neither part a
passage nor make one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderline.llm.common import BLANKS, broadcast_if_small, let, store, stored
from larderline.workspace import drop_folder

# Words, by the spaces between them, that make a line a passage of its own.
PASSAGE_WORDS = 50

# A line break that a line with something in it follows.
_NEXT_LINE = r"\n(?=[\x20\x09\x0B-\x0D]*[^\x20\x09-\x0D])"


def lines_of(text: Column) -> Column:
    """The lines of a text that are not blank, each with the blank ones after it;
    blank ones before the first are an element of their own."""
    return F.split(F.coalesce(text, F.lit("")), _NEXT_LINE, -1)


def _bare(line: Column) -> Column:
    """A line without the blank ones after it."""
    return F.substring_index(line, "\n", 1)


def _is_passage(line: Column, passage_words: int) -> Column:
    """Whether there are spaces enough: only then is the part before the last of
    so many shorter than the line. It looks no further than that space."""
    before = F.substring_index(line, " ", passage_words - 1)
    return F.octet_length(before) < F.octet_length(line)


def _windows(lines: Column, passage_words: int) -> Column:
    """What is looked up: ``place`` of a line, ``span`` in lines (two, or one for a
    passage) and ``hash``."""

    def of(marks: Column) -> Column:
        def at(mark: Column, place: Column) -> Column:
            after = F.get(marks, place + 1)
            rolling = F.when(
                mark.filled & after.bare.isNotNull(), F.xxhash64(F.lit(2), mark.whole, after.bare)
            )
            alone = F.when(mark.passage, F.xxhash64(F.lit(1), mark.bare))
            return F.array(
                F.struct(place.alias("place"), F.lit(2).alias("span"), rolling.alias("hash")),
                F.struct(place.alias("place"), F.lit(1).alias("span"), alone.alias("hash")),
            )

        return F.filter(F.flatten(F.transform(marks, at)), lambda found: found.hash.isNotNull())

    def mark(line: Column) -> Column:
        bare = _bare(line)
        return F.struct(
            F.xxhash64(line).alias("whole"),
            F.xxhash64(bare).alias("bare"),
            (F.btrim(bare, F.lit(BLANKS)) != "").alias("filled"),
            _is_passage(bare, passage_words).alias("passage"),
        )

    return let(F.transform(lines, mark), of)


def _window_text(lines: Column, window: Column) -> Column:
    one, two = F.get(lines, window.place), F.get(lines, window.place + 1)
    return F.when(window.span == 1, _bare(one)).otherwise(F.concat(one, F.lit("\n"), _bare(two)))


def _without_place(placed: Column) -> Column:
    return F.substr(placed, F.locate(":", placed) + 1)


def _placed(place: Column, line: Column) -> Column:
    return F.concat_ws(":", place.cast("string"), line)


def _kept(lines: Column, gone: Column) -> Column:
    """The text without the lines of the windows that are gone, and their number."""

    def without(covered: Column) -> Column:
        # Place and line in one string, because sets of strings are hashed.
        every = F.transform(lines, lambda line, place: _placed(place, line))
        removed = F.transform(covered, lambda place: _placed(place, F.get(lines, place)))
        stay = F.transform(F.array_except(every, removed), _without_place)
        return F.struct(
            F.array_join(stay, "\n").alias("cleaned"),
            F.size(covered).cast("long").alias("n_removed"),
        )

    same = F.filter(gone, lambda window: _window_text(lines, window) == window.text)
    covered = F.flatten(
        F.transform(
            same, lambda window: F.sequence(window.place, window.place + window.span - 1)
        )
    )
    return let(F.array_distinct(covered), without)


def remove_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    passage_words: int = PASSAGE_WORDS,
) -> DataFrame:
    """Each row as the struct ``document``, the text ``cleaned`` of repeats, and
    how many lines it had (``n_chunks``) and lost (``n_removed``).

    Two neighbouring lines that are not blank, or a line of ``passage_words``
    words, stay where they stand first, by id, then by place; elsewhere they go,
    within a document too. What several of them cover goes as one chunk. The
    other lines keep their order. A line that goes stands earlier, next to one
    that it has beside it here.

    NULL stays NULL, and an empty text empty. A NULL id counts as the smallest.
    Rows equal in id and text are the same document told twice: they lose the
    same lines, and none to each other. An empty table gives no rows.

    What is shuffled is a hash and a place for each line, the texts of repeated
    neighbours, and the documents that have or lose some. Counting starts in map
    tasks, and the joins are such that AQE splits a heavy key, so lines that a
    third of all documents have are no heavy group.
    """
    keyed = docs.select(
        F.struct(*docs.columns).alias("document"),
        F.col(id_column).alias("id"),
        F.xxhash64(id_column, text_column).alias("row"),
    )
    # The text is carried once, within the document.
    text = F.col("document")[text_column]
    lines = lines_of(text)
    found = let(lines, lambda own: _windows(own, passage_words))
    occurrences, occurrences_path = store(
        keyed.filter(text.isNotNull()).select("id", "row", F.inline(found)), "windows"
    )
    # Hashes of places, as sums of numbers are cheap; a window repeats if it has
    # two places.
    place_hash = F.xxhash64("id", "row", "place")
    repeated, repeated_path = store(
        occurrences.groupBy("hash")
        .agg(F.min(place_hash).alias("one"), F.max(place_hash).alias("other"))
        .filter("one != other")
        .select("hash"),
        "repeated",
    )
    candidates = stored(
        occurrences.join(broadcast_if_small(repeated), "hash").distinct(), "candidates"
    )
    for path in (occurrences_path, repeated_path):
        drop_folder(docs.sparkSession, path)
    at = F.struct("id", "row", "place")
    firsts = candidates.groupBy("hash", "span").agg(F.min(at).alias("first"))
    wanted = (
        firsts.groupBy(F.col("first.id").alias("own_id"), F.col("first.row").alias("own_row"))
        .agg(F.collect_list(F.struct("first.place", "span", "hash")).alias("windows"))
    )
    lists = broadcast_if_small(stored(wanted, "lists"))
    # The text of each repeated window, taken from its first occurrence.
    same_row = (F.col("row") == F.col("own_row")) & F.col("id").eqNullSafe(F.col("own_id"))
    texts = F.transform(
        "windows",
        lambda window: F.struct(
            window.hash.alias("hash"),
            window.place.alias("first_place"),
            _window_text(F.col("lines"), window).alias("text"),
        ),
    )
    first_texts = stored(
        keyed.join(lists, same_row)
        .withColumn("lines", lines)
        .select("id", "row", F.inline(texts))
        .groupBy("hash")
        .agg(
            F.first(F.struct("id", "row", F.col("first_place").alias("place"))).alias("first"),
            F.first("text").alias("text"),
        ),
        "texts",
    )
    gone = (
        candidates.join(first_texts, "hash")
        .filter(~at.eqNullSafe(F.col("first")))
        .groupBy(F.col("id").alias("own_id"), F.col("row").alias("own_row"))
        .agg(F.collect_list(F.struct("place", "span", "text")).alias("gone"))
    )
    met = keyed.join(gone, same_row, "left").withColumn("lines", lines)
    unchanged = F.struct(text.alias("cleaned"), F.lit(0).cast("long").alias("n_removed"))
    cleaned = F.when(F.col("gone").isNull(), unchanged).otherwise(_kept(F.col("lines"), F.col("gone")))
    return met.select(
        "document",
        F.when(text.isNull(), F.lit(0)).otherwise(F.size("lines")).cast("long").alias("n_chunks"),
        cleaned.alias("found"),
    ).select("document", "found.cleaned", "n_chunks", "found.n_removed")


def without_repeats(
    docs: DataFrame,
    text_column: str = "text",
    length_column: str = "n_chars",
    **options,
) -> DataFrame:
    """The documents without the lines that repeat, in the same columns.

    The column of text lengths, if there is one, follows the text. A document
    that loses lines and has no words left is dropped.
    """
    found = remove_repeats(docs, text_column=text_column, **options)
    blank = F.btrim("cleaned", F.lit(BLANKS)) == ""
    cleaned = {text_column: F.col("cleaned"), length_column: F.length("cleaned").cast("long")}
    return found.filter((F.col("n_removed") == 0) | ~blank).select(
        *[cleaned.get(name, F.col("document")[name]).alias(name) for name in docs.columns]
    )
