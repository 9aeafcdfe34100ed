from __future__ import annotations

import math
import random
import time
from collections import Counter
from itertools import combinations, product

import pytest

from larderline.llm import url_rules

SCHEMA = "page_id long, url string"


def plain(url):
    """Host, path and the longest fitting rule."""
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    end = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:].split("?")[0].split("#")[0]
    fits = [
        rule_host + rule_path
        for _, rule_host, rule_path in url_rules.STATED_RULES
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path)
    ]
    return host, path, max(fits, key=len, default=None)


ODD = [
    None,
    "",
    "no url",
    "://",
    "://x",
    "http://",
    "http:///path",
    "http://NET/",
    "http://net",
    "http://net?x=/",
    "http://a.net/en/",
    "http://example.net/en/1",
    "http://example.net/en",
    "http://notexample.net/en/1",
    "http://A.Example.NET/en/1?u=http://b.org/fr/",
    "ftp://É.example.com/de/x#y",
    "http://example.com/DE/1",
    "http://x.org/fr/1\nsecond line",
    "\nhttp://x.org/fr/",
    "a://b://c.net/d",
    "http://user@x.net:80/a",
    "http://net./a",
]


def judged(spark, urls, **options):
    pages = spark.createDataFrame(list(enumerate(urls)), SCHEMA)
    return {row.id: row for row in url_rules.judge_urls(pages, **options).collect()}


def test_stated_rules(spark):
    found = judged(spark, ODD)
    verdicts = {host + path: verdict for verdict, host, path in url_rules.STATED_RULES}
    for number, url in enumerate(ODD):
        row = found[number]
        assert (row.host, row.path, row.rule) == plain(url), url
        if row.rule:
            assert row.verdict == verdicts[row.rule] and row.because is None
    assert found[0].verdict == url_rules.DEFAULT_VERDICT


def wilson(right, n):
    share, spread = right / n, url_rules.Z**2 / n
    wide = url_rules.Z * math.sqrt((share * (1 - share) + spread / 4) / n)
    return (share + spread / 2 - wide) / (1 + spread)


def plain_rules(labelled, support=url_rules.SUPPORT):
    """All rules of up to three tokens, by counting every combination."""
    rules = {}
    for size in (1, 2, 3):
        counts = Counter()
        for tokens, verdict in labelled:
            for own in combinations(tokens, size):
                counts[own, verdict] += 1
                counts[own] += 1
        for (tokens, verdict), right in [item for item in counts.items() if isinstance(item[0][0], tuple)]:
            n = counts[tokens]
            if right >= support * len(labelled) and wilson(right, n) >= url_rules.CONFIDENCE:
                rules[tokens, verdict] = right / n
    return {
        (tokens, verdict): sure
        for (tokens, verdict), sure in rules.items()
        if not any(rules.get((few, verdict), 0) >= sure for few in combinations(tokens, len(tokens) - 1))
    }


def mined(spark, labelled, **options):
    """Rules by token: each of a group stands for all of it."""
    rows = spark.createDataFrame(labelled, "tokens array<string>, verdict string")
    found = url_rules.mined_rules(rows, **options)
    of_group = {}
    for row in found.members.collect():
        of_group.setdefault(row.group, []).append(row.token)
    return {
        (tuple(sorted(tokens)), r.verdict): r.confidence
        for r in found.rules.collect()
        for tokens in product(*[of_group[group] for group in r.groups])
    }


def some_labelled(seed, letters, most):
    draw = random.Random(seed)
    for _ in range(800):
        tokens = sorted(draw.sample(letters, draw.randrange(1, most)))
        block = "a" in tokens and ("b" in tokens or draw.random() < 0.7)
        yield tokens, "block" if block else "allow"


@pytest.mark.parametrize("most_groups", [url_rules.MOST_GROUPS, 2])
def test_mined_rules_are_those_of_counting_all_combinations(spark, most_groups):
    labelled = list(some_labelled(3, "abcdef", 5))
    # Tokens that only occur together, with and without exceptions.
    labelled += [(["c", "x1", "x2", "x3"], "block" if n % 40 else "allow") for n in range(120)]
    labelled += [(["y1", "y2"], "block")] * 25 + [(["z"], "block")] * 24
    found = mined(spark, labelled, most_groups=most_groups)
    assert found == pytest.approx(plain_rules(labelled))
    assert (("a", "b"), "block") in found and (("y1",), "block") in found
    assert not any("z" in tokens for tokens, _ in found)


def test_large_baskets_are_counted_by_length(spark):
    letters = [chr(97 + n) for n in range(20)]
    labelled = list(some_labelled(5, letters, 18))
    assert mined(spark, labelled) == pytest.approx(plain_rules(labelled))


def test_long_urls_that_repeat_end_soon(spark):
    """Copies of a long URL, and long URLs that share most of their parts."""
    copies = "http://a.example.com/de/" + "/".join(f"p{n}" for n in range(300))
    urls = [copies] * 25
    shared = "/".join(f"s{n}" for n in range(30))
    urls += [f"http://h{n}.example.org/fr/{shared}/{n % 7}x" for n in range(1000)]
    urls += [f"http://h{n}.example.com/de/{shared}/{n % 7}x" for n in range(500)]
    urls += ["http://x.info/p7/p9", "http://x.info/s3", "http://com.info/de/s3"]
    began = time.monotonic()
    found = judged(spark, urls)
    assert time.monotonic() - began < 60
    last = [found[len(urls) - n] for n in (3, 2, 1)]
    assert [r.verdict for r in last] == ["block", "allow", "block"]
    assert last[1].because is None and last[0].because == ["path:p7"]
    assert last[2].because == ["host:com"]


def test_support_does_not_hang_on_copies_of_the_table(spark):
    labelled = list(some_labelled(3, "abcdef", 5))
    assert set(mined(spark, labelled)) <= set(mined(spark, labelled * 4))


def test_other_urls_follow_what_is_mined(spark):
    urls = [f"http://h{n % 40}.example.com/de/shop/{n}" for n in range(200)]
    urls += [f"http://h{n % 40}.example.org/fr/news/{n}" for n in range(200)]
    urls += ["http://other.info/shop/1", "http://other.info/news/1", "http://other.info/1"]
    found = judged(spark, [*urls, urls[-3]])
    assert [found[400 + n].verdict for n in range(4)] == ["block", "allow", "allow", "block"]
    assert "path:shop" in found[400].because and found[400].rule is None
    assert found[402].because is None


def test_repeated_rows_other_columns_and_none(spark):
    pages = spark.createDataFrame([(1, "http://a.net/", "h", "r")] * 3, SCHEMA + ", host string, rule string")
    assert [r.rule for r in url_rules.judge_urls(pages).collect()] == ["net/"] * 3
    assert url_rules.judge_urls(spark.createDataFrame([], SCHEMA)).count() == 0


def test_very_long_url(spark):
    found = judged(spark, ["http://" + "a." * 300 + "net/" + "x/" * 50_000])
    assert found[0].rule == "net/" and len(found[0].path) == 100_001
