"""Periodic runs against all stretches of small texts, and planted periods."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from larderline.llm import periodic_runs
from larderline.llm.queries import QUERIES

COLUMNS = (
    "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256",
)


def smallest_period(words):
    return next(q for q in range(1, len(words) + 1) if words[q:] == words[: len(words) - q])


def plain_runs(words, least=12):
    """Every maximal stretch of each period, then those whose period is smallest."""
    runs = []
    for q in range(1, len(words) // 2 + 1):
        start = 0
        for at in range(q, len(words) + 1):
            if at == len(words) or words[at] != words[at - q]:
                length = at - start
                if length >= max(least, 2 * q) and smallest_period(words[start:at]) == q:
                    runs.append((start, length, q))
                start = at - q + 1
    return sorted(runs, key=lambda run: (run[0], run[2]))


def plain_row(words):
    runs = plain_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    longest = min(runs, key=lambda run: (-run[1], run[0], run[2]), default=(None,) * 3)
    exponent = None if longest[0] is None else 1000 * longest[1] // longest[2]
    digests = [hashlib.sha256(text.encode()).hexdigest() for text in (lines, kept)]
    return (len(runs), *longest, exponent, *digests)


def rows_of(spark, rows, schema="doc_id long, text string"):
    found = periodic_runs.find_runs(spark.createDataFrame(rows, schema))
    return {r.id: tuple(r[c] for c in COLUMNS) for r in periodic_runs.summary(found).collect()}


def random_texts():
    draw = random.Random(5)
    for n in range(600):
        letters = "abcd"[: draw.randint(1, 4)]
        words = draw.choices(letters, k=draw.randint(0, 70))
        if n % 2 and words:
            piece = draw.choices(letters, k=draw.randint(1, 9))
            at = draw.randint(0, len(words))
            words[at:at] = (piece * 20)[: draw.randint(10, 60)]
        yield words


def test_runs_are_those_of_all_stretches():
    for words in random_texts():
        assert periodic_runs.runs_of(words) == plain_runs(words), words


def test_nested_runs_of_several_periods():
    words = (("x " * 14 + "y ") * 3 + "z").split()
    found = periodic_runs.runs_of(words)
    assert found == plain_runs(words)
    assert {q for _, _, q in found} == {1, 15}


def test_long_texts_of_one_word_and_of_fibonacci_words():
    assert periodic_runs.runs_of([b"buy"] * 200_000) == [(0, 200_000, 1)]
    a, b = "a", "ab"
    while len(b) < 2000:
        a, b = b, b + a
    assert periodic_runs.runs_of(list(b[:600])) == plain_runs(list(b[:600]))
    assert len(periodic_runs.runs_of(list(b))) > 100


def test_a_shorter_least_length_is_refused():
    with pytest.raises(ValueError):
        periodic_runs.runs_of([], 4)


def test_summary_nulls_empty_and_repeated_rows(spark):
    texts = [None, "", " \t\n", "one two", "ha " * 30, "a\tb\n" * 7 + "c", "ü x " * 12]
    rows = [(i, t) for i, t in enumerate(texts)] + [(4, "ha " * 30), (None, "ho " * 12)]
    found = rows_of(spark, rows)
    for doc_id, text in rows:
        words = [w for w in (text or "").encode().split()]
        assert found[doc_id] == plain_row([w.decode() for w in words]), doc_id


def test_collapsed_text(spark):
    docs = spark.createDataFrame([(1, "start " + "go on " * 8 + "end")], "doc_id long, text string")
    (row,) = periodic_runs.find_runs(docs).collect()
    assert row.collapsed == "start go on end"
    assert [tuple(run) for run in row.runs] == [(1, 16, 2)]


def test_empty_table_and_clashing_columns(spark):
    assert rows_of(spark, []) == {}
    rows = [(1, "a " * 12, "x", 5)]
    assert rows_of(spark, rows, "doc_id long, text string, id string, runs int")[1][:4] == (1, 0, 12, 1)


def planted_words(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return [w.decode() for w in words]


def test_query_on_the_test_table(spark, tables):
    """The longest texts are left to the test of random ones: trying all is slow."""
    docs = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").collect()
    found = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in QUERIES["op12_periodic_runs"](spark, tables).collect()}
    assert set(found) == {r.doc_id for r in docs}
    assert sum(row[0] > 0 for row in found.values()) > 10
    for row in docs:
        words = planted_words(row.doc_id, row.text)
        if len(words) < 1500:
            assert found[row.doc_id] == plain_row(words), row.doc_id
