from __future__ import annotations

import random

import pytest

from larderline.llm import quality

SCHEMA = "doc_id long, text string, source string"


def plain_measures(text):
    text = text or ""
    for blank in "\t\x0b\x0c\r":
        text = text.replace(blank, " ")
    lines = [line for line in text.split("\n") if line.strip(" ")]
    words = [word for word in text.replace("\n", " ").split(" ") if word]
    places = {}
    for at in range(len(words) - 4):
        places.setdefault(tuple(words[at : at + 5]), []).append(at)
    covered = {at + k for found in places.values() if len(found) > 1 for at in found for k in range(5)}
    symbols = sum(text.count(symbol) for symbol in "#*$%&|<>")
    return (len(words), sum(map(len, words)), symbols, len(covered))


def measured(spark, texts):
    docs = spark.createDataFrame([(n, t, "h") for n, t in enumerate(texts)], SCHEMA)
    rows = quality.judge(docs, carry=["doc_id"]).orderBy("document.doc_id").collect()
    return rows


def test_measures_are_those_of_a_plain_count(spark):
    draw = random.Random(2)
    texts = [None, "", " \t\r\n", "a", "a b c d e", "é€ 🦆 x", "# * $%&|<> a\n\n\nb"]
    for size in (4, 5, 6, 9, 30, 300):
        for kinds in (1, 2, 5, 50):
            words = [f"w{draw.randrange(kinds)}" for _ in range(size)]
            texts.append(" ".join(words))
            texts.append("\x0b".join(words) + "\n" + " ".join(words))
    for row, text in zip(measured(spark, texts), texts, strict=True):
        got = (row.n_words, row.word_chars, row.n_symbols, row.n_repeat_words)
        assert got == plain_measures(text), text


def test_repeated_lines_count_from_the_second_on(spark):
    texts = ["a\nb\na\n\n\n a\na", "\n\n", "x\r\nx\r\nx", None]
    assert [row.n_dup_lines for row in measured(spark, texts)] == [2, 0, 1, 0]


def test_very_long_text(spark):
    words = [f"w{n}" for n in range(150_000)]
    rows = measured(spark, [" ".join(words), " ".join([*words, *words[:7]])])
    assert [row.n_repeat_words for row in rows] == [0, 14]
    assert all(row.n_words >= 150_000 and row.kept for row in rows)


def good(n):
    return " ".join(f"word{n}x{k}" for k in range(30))


def test_hosts_decide_on_documents_that_fail_a_minor_rule(spark):
    symbols = " ".join(["##", *[f"word{k}" for k in range(10)]])
    rows = [(n, good(n), "clean") for n in range(200)] + [(200, symbols, "clean")]
    rows += [(300 + n, "too short", "junk") for n in range(30)]
    rows += [(400, symbols, "junk"), (401, good(401), "junk")]
    found = {r.document.doc_id: r for r in quality.judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found[200].minor_failures == found[400].minor_failures == 1
    assert found[200].kept and not found[400].kept
    assert found[401].kept and found[401].bad_host
    assert not found[300].kept
    assert found[401].host == "junk" and found[401].failures == 31


def test_small_hosts_are_shrunk_towards_all_hosts(spark):
    # Three in a hundred fail at each large host, and the one of a small host.
    rows = [(n, "short" if n % 100 < 3 else good(n), f"host{n // 100}") for n in range(2000)]
    rows.append((9000, "short", "tiny"))
    hosts = {r.host: r.rate for r in quality.judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert 0.03 <= round(hosts["host0"], 3) < hosts["tiny"] < 0.05


def test_null_hosts_repeated_rows_and_other_columns(spark):
    rows = [(1, good(1), None, "a", 5), (1, good(1), None, "a", 5), (None, None, None, "b", 6)]
    docs = spark.createDataFrame(rows, SCHEMA + ", kept string, n_words int")
    judged = quality.judge(docs).collect()
    assert sorted(r.kept for r in judged) == [False, True, True]
    assert {r.documents for r in judged} == {3}
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert kept.collect() == rows[:2]


def test_no_documents(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert quality.judge(docs).count() == 0
    assert quality.keep_good(docs).columns == docs.columns


@pytest.mark.parametrize("rows, mean", [([], 0.0), ([("a", 10, 0)], 0.0), ([("a", 4, 1)], 0.25)])
def test_prior_of_few_hosts(spark, rows, mean):
    hosts = spark.createDataFrame(rows, "host string, documents long, failures long")
    assert quality._prior(hosts) == (mean, quality.STRONGEST)
