"""Judge URLs by stated rules, and by mined ones where none of those fits.

A stated rule names a host and the start of a path. URLs that such a rule judges
are the labelled examples: FP-growth finds the combinations of URL tokens that
are frequent among them, and those that imply a verdict become rules for all
other URLs. A URL meets the mined rules through an inverted index: the rarest
token of a rule is its key, and only rules whose key the URL has are compared.

FP-growth enumerates all combinations of the frequent tokens of a basket, so its
baskets are made small first, without a loss. Tokens of exactly the same URLs are
one group. A group that implies its verdict without exception is a rule of its
own; more tokens cannot make it surer, so it leaves the baskets. Should baskets
still be large, combinations are counted by length instead.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderline.llm.common import broadcast_if_small, stored

# Verdict, host, start of the path.
STATED_RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
DEFAULT_VERDICT = "allow"

# Mined rules are right for this share of the labelled URLs at least, and, with
# the certainty of Z standard deviations, for that share of those they hold for.
# They have few tokens.
SUPPORT = 0.002
CONFIDENCE = 0.9
Z = 1.645
MOST_TOKENS = 3
# Groups of a basket that FP-growth may enumerate all combinations of.
MOST_GROUPS = 12
# Copies of a basket that one array holds.
COPIES_AT_ONCE = 1000

_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def _lower_ascii(text: Column) -> Column:
    return F.translate(text, _CAPITALS, _CAPITALS.lower())


def host_of(url: Column) -> Column:
    """What follows the first ``://``, up to a slash, question mark or hash."""
    return _lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1))


def path_of(url: Column) -> Column:
    """What follows the host, up to a question mark or hash."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """The distinct tokens of a URL, sorted: labels of the host, parts of the
    path, names of query fields. Numbers in a path are one token."""
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("host:"), x))
    parts = F.transform(
        F.split(path, "[/.]"),
        lambda x: F.concat(F.lit("path:"), F.regexp_replace(_lower_ascii(x), "^[0-9]+$", "0")),
    )
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\?([^#]*)", 1)
    fields = F.transform(
        F.split(query, "&"), lambda x: F.concat(F.lit("query:"), F.substring_index(x, "=", 1))
    )
    named = F.filter(F.concat(labels, parts, fields), lambda x: ~x.endswith(":"))
    return F.array_sort(F.array_distinct(named))


def _stated_by_host(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``host`` and the ``stated`` rules for it or a domain it belongs to."""
    labels = F.split("host", r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda start: F.array_join(F.slice(labels, start, F.size(labels)), "."),
    )
    one = F.struct(
        F.length(F.concat("rule_host", "rule_path")).alias("length"),
        F.concat("rule_host", "rule_path").alias("rule"),
        F.col("rule_path").alias("path"),
        F.col("rule_verdict").alias("verdict"),
    )
    return (
        hosts.select("host", F.explode(domains).alias("rule_host"))
        .join(rules, "rule_host")
        .groupBy("host")
        .agg(F.collect_set(one).alias("stated"))
    )


class Mined(NamedTuple):
    """``rules`` with the ``groups`` of tokens that imply a ``verdict``, their
    ``confidence`` and ``support``, and ``members``: each ``token`` with its
    ``group``. A URL has a group if it has one of its tokens."""

    rules: DataFrame
    members: DataFrame


def sure_share(right: Column, n: Column) -> Column:
    """The lower end of Wilson's interval for the share that is right."""
    share, spread = right / n, Z * Z / n
    wide = Z * F.sqrt((share * (1 - share) + spread / 4) / n)
    return (share + spread / 2 - wide) / (1 + spread)


def least_urls(confidence: float) -> int:
    """With fewer URLs no rule can be sure enough, even without an exception."""
    return math.ceil(Z * Z * confidence / (1 - confidence))


def _grouped(sets: DataFrame, needed: float) -> DataFrame:
    """The frequent tokens with the ``group`` of tokens that the same rows have,
    named by the least of them, how often it occurs, and whether for one verdict
    only. Rows are the same by two hashes over all of them."""
    row = F.struct("tokens", "verdict")
    by_token = (
        sets.withColumns({"a": F.xxhash64(row), "b": F.xxhash64(F.lit("b"), row)})
        .select("verdict", "n", "a", "b", F.explode("tokens").alias("token"))
        .groupBy("token")
        .agg(
            F.sum("n").alias("n"),
            F.bit_xor("a").alias("a"),
            F.bit_xor("b").alias("b"),
            F.min("verdict").alias("verdict"),
            (F.min("verdict") == F.max("verdict")).alias("pure"),
        )
        .filter(F.col("n") >= needed)
    )
    by_token = stored(by_token, "tokens")
    names = by_token.groupBy("n", "a", "b").agg(F.min("token").alias("group"))
    return stored(by_token.join(names, ["n", "a", "b"]).drop("a", "b"), "groups")


def _copied(baskets: DataFrame) -> DataFrame:
    """Each basket as often as it occurs, in two steps so that no array is long."""
    starts = F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(COPIES_AT_ONCE).cast("long"))
    some = F.least(F.col("n") - F.col("start"), F.lit(COPIES_AT_ONCE).cast("long"))
    return (
        baskets.withColumn("start", F.explode(starts))
        .withColumn("copy", F.explode(F.array_repeat(F.lit(True), some.cast("int"))))
        .drop("start", "copy", "n")
    )


def _by_growth(baskets: DataFrame, needed: float, total: int, most_tokens: int) -> DataFrame:
    """Combinations ``groups`` with how often they occur (``n``) and do so with a
    ``verdict`` (``right``), by FP-growth."""
    mark = F.concat(F.lit("verdict:"), F.col("verdict"))
    items = _copied(baskets).select(F.array_append("groups", mark).alias("items"))
    # Half a row less, so that rounding asks for no row too many.
    share = (math.ceil(needed) - 0.5) / max(total, 1)
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, max(share, 0.0)), minConfidence=0.0)
    frequent = stored(model.fit(items).freqItemsets, "itemsets")
    is_mark = F.filter("items", lambda x: x.startswith("verdict:"))
    marked = frequent.filter(F.size(is_mark) == 1).select(
        F.array_sort(F.array_except("items", is_mark)).alias("groups"),
        F.substring_index(is_mark[0], ":", -1).alias("verdict"),
        F.col("freq").alias("right"),
    )
    plain = frequent.filter(F.size(is_mark) == 0).select(
        F.array_sort("items").alias("groups"), F.col("freq").alias("n")
    )
    return marked.join(plain, "groups").filter(F.size("groups") <= most_tokens)


def _by_length(baskets: DataFrame, needed: float, most_tokens: int) -> DataFrame:
    """The same, counted length by length: a combination goes on to the next only
    if it is frequent and has exceptions, or none longer could be surer."""
    spark = baskets.sparkSession
    schema = "groups array<string>, verdict string, right long, n long"
    found = spark.createDataFrame([], schema)
    growing = baskets.select(
        F.array().cast("array<string>").alias("groups"), F.col("groups").alias("rest"), "verdict", "n"
    )
    for _ in range(most_tokens):
        longer = growing.select(
            "groups", "rest", "verdict", "n", F.posexplode("rest").alias("at", "next")
        ).select(
            F.array_append("groups", F.col("next")).alias("groups"),
            F.slice("rest", F.col("at") + 2, F.size("rest")).alias("rest"),
            "verdict",
            "n",
        )
        counts = longer.groupBy("groups", "verdict").agg(F.sum("n").alias("right"))
        totals = counts.groupBy("groups").agg(
            F.sum("right").alias("n"), F.max("right").alias("most")
        )
        totals = stored(totals.filter(F.col("n") >= needed), "totals")
        found = found.union(
            stored(
                counts.join(totals, "groups").select("groups", "verdict", "right", "n"), "counts"
            )
        )
        open_ones = totals.filter(F.col("most") < F.col("n")).select("groups")
        growing = stored(longer.join(open_ones, "groups", "left_semi"), "growing")
    return found


def mined_rules(
    labelled: DataFrame,
    support: float = SUPPORT,
    confidence: float = CONFIDENCE,
    most_tokens: int = MOST_TOKENS,
    most_groups: int = MOST_GROUPS,
) -> Mined:
    """Rules of up to ``most_tokens`` tokens from rows of ``tokens``, sorted and
    distinct, and ``verdict``; none from no rows.

    A rule is right for a share ``support`` of the rows, and, by the lower end of
    Wilson's interval, for a share ``confidence`` of those it holds for; that
    alone asks for more rows where there are few. A rule goes if one with fewer
    of its tokens has the same verdict and at least its confidence. The number of
    rules is bounded by the support, not by the number of rows or their copies.
    """
    sets = stored(
        labelled.groupBy("tokens", "verdict").agg(F.count(F.lit(1)).alias("n")), "token_sets"
    )
    total = sets.agg(F.sum("n")).first()[0] or 0
    needed = max(support * total, least_urls(confidence))
    groups = _grouped(sets, needed)
    alone = groups.filter("pure").select(
        F.array("group").alias("groups"), "verdict", F.col("n").alias("right"), "n"
    )
    mixed = broadcast_if_small(
        stored(groups.filter("NOT pure").select("token", F.col("group").alias("one")), "mixed")
    )
    numbered = stored(sets.withColumn("row", F.monotonically_increasing_id()), "numbered")
    baskets = stored(
        numbered.select("row", "verdict", "n", F.explode("tokens").alias("token"))
        .join(mixed, "token")
        .groupBy("row", "verdict", "n")
        .agg(F.array_sort(F.collect_set("one")).alias("groups"))
        .groupBy("groups", "verdict")
        .agg(F.sum("n").alias("n")),
        "baskets",
    )
    largest = baskets.agg(F.max(F.size("groups"))).first()[0] or 0
    if largest <= most_groups:
        in_baskets = baskets.agg(F.sum("n")).first()[0] or 0
        counted = _by_growth(baskets, needed, in_baskets, most_tokens)
    else:
        counted = _by_length(baskets, needed, most_tokens)
    rules = stored(
        alone.distinct()
        .unionByName(counted)
        .filter(F.col("right") >= needed)
        .filter(sure_share(F.col("right"), F.col("n")) >= confidence)
        .select(
            "groups",
            "verdict",
            (F.col("right") / F.col("n")).alias("confidence"),
            (F.col("right") / F.lit(max(total, 1))).alias("support"),
        ),
        "rules",
    )
    # Each rule with its groups less one; what is implied by fewer is implied
    # step by step.
    fewer = rules.select(
        "groups", "verdict", F.col("confidence").alias("own"), F.explode("groups").alias("left_out")
    ).withColumn("subset", F.array_remove("groups", F.col("left_out")))
    simpler = rules.select(
        F.col("groups").alias("subset"), "verdict", F.col("confidence").alias("simple")
    )
    implied = fewer.join(simpler, ["subset", "verdict"]).filter(F.col("simple") >= F.col("own"))
    needless = implied.select("groups", "verdict").distinct()
    kept = rules.join(needless, ["groups", "verdict"], "left_anti")
    return Mined(kept, groups.select("token", "group"))


def _mined_verdicts(token_sets: DataFrame, mined: Mined) -> DataFrame:
    """``tokens`` and the verdict of the surest rule that they meet."""
    numbered = stored(token_sets.withColumn("row", F.monotonically_increasing_id()), "open_sets")
    members = broadcast_if_small(mined.members)
    having = stored(
        numbered.select("row", F.explode("tokens").alias("token"))
        .join(members, "token")
        .groupBy("row")
        .agg(
            F.collect_set("group").alias("groups"),
            F.collect_set(F.struct("group", "token")).alias("met"),
        ),
        "having",
    )
    each = having.select("row", "groups", "met", F.explode("groups").alias("group"))
    counts = each.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
    keyed = (
        mined.rules.withColumnRenamed("groups", "rule_groups")
        .withColumn("group", F.explode("rule_groups"))
        .join(counts, "group")
        .groupBy("rule_groups", "verdict", "confidence", "support")
        .agg(F.min_by("group", F.struct("n", "group")).alias("group"))
    )
    index = broadcast_if_small(stored(keyed, "index"))
    sure = F.struct("confidence", "support", "rule_groups", "verdict")
    best = (
        each.join(index, "group")
        .filter(F.size(F.array_except("rule_groups", "groups")) == 0)
        .groupBy("row")
        .agg(F.max(sure).alias("best"), F.max("met").alias("met"))
    )
    # What the URL has of each group of the rule, the first by name.
    ordered = F.array_sort("met")
    because = F.transform(
        "best.rule_groups",
        lambda group: F.filter(ordered, lambda x: x.group == group)[0].token,
    )
    return numbered.join(best, "row").select(
        "tokens", F.col("best.verdict").alias("mined"), because.alias("because")
    )


def judge_urls(
    pages: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    rules: Sequence[tuple[str, str, str]] = STATED_RULES,
    support: float = SUPPORT,
    confidence: float = CONFIDENCE,
) -> DataFrame:
    """``id``, ``host``, ``path``, stated ``rule`` (NULL if none fits), ``verdict``
    and the tokens of a mined rule it is due to (``because``; of tokens that
    labelled URLs only have together, the first by name that it has).

    A stated rule fits its host and all below it, if the path starts with the
    rule's. The longest one wins; of equal ones, the verdict later in the
    alphabet. NULL and what is no URL have empty host and path, fit no rule and
    are allowed. Repeated rows are judged alike.

    Hosts and token sets are made distinct in map tasks before they meet rules,
    so no host is a heavy group; the join back is one that AQE splits.
    """
    spark = pages.sparkSession
    parsed = pages.select(
        F.col(id_column).alias("id"),
        F.col(url_column).alias("url"),
        host_of(F.col(url_column)).alias("host"),
        path_of(F.col(url_column)).alias("path"),
    )
    tokens = tokens_of(F.col("url"), F.col("host"), F.col("path"))
    rows = stored(parsed.withColumn("tokens", tokens).drop("url"), "urls")
    table = spark.createDataFrame(
        list(rules), "rule_verdict string, rule_host string, rule_path string"
    )
    by_host = broadcast_if_small(
        stored(_stated_by_host(rows.select("host").distinct(), table), "stated")
    )
    fitting = F.filter("stated", lambda rule: F.startswith(F.col("path"), rule.path))
    met = rows.join(by_host, "host", "left")
    stated = met.withColumn("fits", F.array_max(fitting)).drop("stated")
    labelled = stated.filter(F.col("fits").isNotNull()).select(
        "tokens", F.col("fits.verdict").alias("verdict")
    )
    mined = mined_rules(labelled, support, confidence)
    open_sets = stated.filter(F.col("fits").isNull()).select("tokens").distinct()
    by_tokens = broadcast_if_small(stored(_mined_verdicts(open_sets, mined), "mined"))
    return stated.join(by_tokens, "tokens", "left").select(
        "id",
        "host",
        "path",
        F.col("fits.rule").alias("rule"),
        F.coalesce("fits.verdict", "mined", F.lit(DEFAULT_VERDICT)).alias("verdict"),
        F.when(F.col("fits").isNull(), F.col("because")).alias("because"),
    )
