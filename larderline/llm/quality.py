"""Quality rules on documents, and verdicts on the hosts they come from.

Each document is measured and judged by itself. Failures are then counted by
host. A host with few documents says little, so its failure rate is shrunk
towards the rate of all hosts by a beta prior fitted to the hosts' own rates.
Documents that fail a minor rule stay at a trusted host and go at a bad one.
All of it is DataFrame code.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderline.llm.common import BLANKS, broadcast_if_small, let, stored, words

LEAST_WORDS = 10
# Words that repeat in windows of five, as a percentage of all words.
MOST_REPEATED_PERCENT = 20
WINDOW = 5
SYMBOLS = "#*$%&|<>"

# Minor rules: characters a word, symbols in 100 words, lines that repeat
# earlier ones in 100 lines.
LEAST_WORD_CHARS = 2
MOST_WORD_CHARS = 15
MOST_SYMBOLS_PERCENT = 10
MOST_DUP_LINES_PERCENT = 30

# A host is bad if its shrunken failure rate is above this.
MOST_HOST_FAILURES = 0.05
# Bounds of the prior's strength, in documents.
WEAKEST, STRONGEST = 1.0, 1000.0

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_window_words(word_list: Column, window: int = WINDOW) -> Column:
    """Words that stand in a window of so many words found twice or more.

    Windows are compared by their 64-bit hash. Where all hashes differ, which a
    hash set tells, nothing is sorted. Else places are sorted by hash, those
    next to an equal one are kept, and the words they cover are counted once.
    """
    starts = F.sequence(F.lit(0), F.size(word_list) - window)
    hashes = F.transform(
        starts, lambda at: F.xxhash64(*[F.get(word_list, at + k) for k in range(window)])
    )

    def repeated_places(places: Column) -> Column:
        def has_equal(place: Column, at: Column) -> Column:
            before, after = F.get(places, at - 1), F.get(places, at + 1)
            return place.h.eqNullSafe(before.h) | place.h.eqNullSafe(after.h)

        return F.sort_array(F.transform(F.filter(places, has_equal), lambda place: place.at))

    def covered(places: Column) -> Column:
        """A place adds its window, less what the place before it has covered."""
        start = F.struct(F.lit(-window).alias("last"), F.lit(0).alias("n"))
        total = F.aggregate(
            places,
            start,
            lambda seen, at: F.struct(
                at.alias("last"), (seen.n + F.least(F.lit(window), at - seen.last)).alias("n")
            ),
        )
        return total.n

    def count(all_hashes: Column) -> Column:
        placed = F.transform(all_hashes, lambda h, at: F.struct(h.alias("h"), at.alias("at")))
        repeats = let(F.sort_array(placed), repeated_places)
        all_differ = F.size(F.array_distinct(all_hashes)) == F.size(all_hashes)
        return F.when(all_differ, 0).otherwise(covered(repeats))

    return F.when(F.size(word_list) <= window, 0).otherwise(let(hashes, count)).cast("long")


def _count_of(text: Column, characters: str) -> Column:
    """How often the ASCII characters occur, by the bytes that go with them. A
    text without one of them is not copied."""
    rest = text
    for character in characters:
        rest = F.replace(rest, F.lit(character), F.lit(""))
    return F.octet_length(text) - F.octet_length(rest)


def measured(docs: DataFrame, text: Column, *carried: Column) -> DataFrame:
    """The carried columns with the measures of the text, which NULL has none of."""
    whole = docs.select(
        *carried,
        words(text).alias("_words"),
        F.coalesce(text, F.lit("")).alias("_text"),
    )
    lines = F.filter(F.split("_text", "\n", -1), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    dup_lines = let(lines, lambda kept: F.size(kept) - F.size(F.array_distinct(kept)))
    n_lines = _count_of(F.col("_text"), "\n") + 1
    return whole.select(
        *[name for name in whole.columns if not name.startswith("_")],
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        _count_of(F.col("_text"), SYMBOLS).cast("long").alias("n_symbols"),
        dup_lines.cast("long").alias("n_dup_lines"),
        repeated_window_words(F.col("_words")).alias("n_repeat_words"),
        n_lines.cast("long").alias("n_lines"),
    )


def base_failed() -> Column:
    too_repeated = 100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    return (F.col("n_words") < LEAST_WORDS) | too_repeated


def minor_failures() -> Column:
    """How many of the minor rules a document fails; none if it has no words."""
    n, chars = F.col("n_words"), F.col("word_chars")
    fails = (
        (chars < LEAST_WORD_CHARS * n) | (chars > MOST_WORD_CHARS * n),
        100 * F.col("n_symbols") > MOST_SYMBOLS_PERCENT * n,
        100 * F.col("n_dup_lines") > MOST_DUP_LINES_PERCENT * F.col("n_lines"),
    )
    return sum((failed.cast("int") for failed in fails), F.lit(0))


def _prior(hosts: DataFrame) -> tuple[float, float]:
    """Mean and strength of the beta prior, fitted to the rates of all hosts.

    The method of moments: the spread of the rates, weighted by documents, less
    what chance alone explains, is the variance between hosts. Hosts as alike as
    chance allows give the strongest prior.
    """
    x, n = F.col("failures"), F.col("documents")
    total = hosts.agg(
        F.sum(n).alias("n"),
        F.sum(x).alias("x"),
        F.sum(x.cast("double") * x / n).alias("xx"),
        F.sum(n.cast("double") * n).alias("nn"),
        F.count(F.lit(1)).alias("hosts"),
    ).first()
    if not total.n:
        return 0.0, STRONGEST
    mean = total.x / total.n
    chance = mean * (1 - mean)
    spread = total.xx - total.n * mean * mean - (total.hosts - 1) * chance
    room = total.n - total.nn / total.n - (total.hosts - 1)
    if spread <= 0 or room <= 0 or chance == 0:
        return mean, STRONGEST
    return mean, min(STRONGEST, max(WEAKEST, chance * room / spread - 1))


def host_verdicts(judged: DataFrame, most_failures: float = MOST_HOST_FAILURES) -> DataFrame:
    """``host``, its ``documents``, ``failures``, shrunken ``rate`` and ``bad_host``.

    Documents are counted in map tasks first, so no host is a heavy group. NULL
    is a host like any other.
    """
    failed = F.col("base_failed") | (F.col("minor_failures") > 0)
    counted = judged.groupBy("host").agg(
        F.count(F.lit(1)).alias("documents"), F.sum(failed.cast("long")).alias("failures")
    )
    hosts = stored(counted, "hosts")
    mean, strength = _prior(hosts)
    rate = (F.col("failures") + mean * strength) / (F.col("documents") + strength)
    return hosts.withColumn("rate", rate).withColumn("bad_host", F.col("rate") > most_failures)


def judge(
    docs: DataFrame,
    text_column: str = "text",
    host_column: str = "source",
    most_failures: float = MOST_HOST_FAILURES,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """Each row as the struct ``document``, of all columns or those of ``carry``,
    with its measures, ``base_failed``, ``minor_failures``, the figures and the
    verdict of its ``host``, and ``kept``.

    A document is kept if it passes the base rules and fails no minor rule, or
    just one and its host is not bad. So no host can drag down a document that
    fails nothing. NULL and empty texts have no words and fail; equal rows are
    judged alike and each counts for its host. An empty table gives no rows.

    Measures are worked out once and stored with what is carried. The host table
    is broadcast if its counted rows allow it; else AQE splits a heavy host.
    """
    document = F.struct(*[F.col(name) for name in (carry or docs.columns)]).alias("document")
    rows = measured(docs, F.col(text_column), document, F.col(host_column).alias("host"))
    judged = stored(
        rows.withColumn("base_failed", base_failed()).withColumn(
            "minor_failures", minor_failures()
        ),
        "judged",
    )
    hosts = broadcast_if_small(host_verdicts(judged, most_failures).withColumnRenamed("host", "_host"))
    tolerated = F.when(F.col("bad_host"), 0).otherwise(1)
    return (
        judged.join(hosts, F.col("_host").eqNullSafe(F.col("host")), "left")
        .drop("_host")
        .withColumn("kept", ~F.col("base_failed") & (F.col("minor_failures") <= tolerated))
    )


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The documents that ``judge`` keeps, whole rows."""
    return judge(docs, **options).filter("kept").select("document.*")
