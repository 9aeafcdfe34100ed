from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from larderline.llm import language
from larderline.llm.queries import QUERIES

SCHEMA = "doc_id long, text string"
SAMPLES = {
    "aa": ["banana", "papaya", "kala", "mala", "sana"] * 20,
    "ee": ["schlecht", "berg", "zwerg", "stern", "gerste"] * 20,
    "é": ["éclat", "né", "père", "été", "fée"] * 20,
}


@pytest.fixture(scope="module")
def network():
    return language.trained(SAMPLES, steps=150)


def test_slopes_are_those_of_small_differences():
    network = language.Network(["a", "b", "c"], hidden=3, seed=1)
    network.weights = {name: value.astype(np.float64) for name, value in network.weights.items()}
    rows = np.frombuffer(b"abcdebbaaeeccda", dtype=np.uint8).reshape(3, 5)
    labels = np.array([0, 2, 1])

    def loss():
        return -network.log_labels(rows)[np.arange(3), :, labels].mean()

    slopes = network.slopes(rows, labels)
    draw = np.random.default_rng(0)
    for name, value in network.weights.items():
        flat = value.reshape(-1)
        used = np.flatnonzero(slopes[name].reshape(-1))
        for at in draw.choice(used, size=min(12, len(used)), replace=False):
            kept = flat[at]
            flat[at] = kept + 1e-5
            above = loss()
            flat[at] = kept - 1e-5
            below = loss()
            flat[at] = kept
            assert slopes[name].reshape(-1)[at] == pytest.approx((above - below) / 2e-5, rel=1e-2, abs=1e-6)


def test_every_byte_is_labelled_from_both_ends(network):
    rows = np.frombuffer(b"banana", dtype=np.uint8).reshape(1, 6)
    log_labels = network.log_labels(rows)
    assert log_labels.shape == (1, 6, 3)
    assert np.allclose(np.exp(log_labels).sum(axis=2), 1, atol=1e-4)
    other = np.frombuffer(b"bananz", dtype=np.uint8).reshape(1, 6)
    assert not np.allclose(log_labels[0, 0], network.log_labels(other)[0, 0])


def test_predictions_of_odd_texts(spark, network):
    texts = [None, "", "12 ² ½ 34!", "Banana PAPAYA", "Zwerg, Stern.", "père été", "sana" * 100_000, "ß ŉ 漢字"]
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    found = [r for r in language.predict(docs, network).orderBy("id").collect()]
    assert [r.lang_pred for r in found[:7]] == ["und", "und", "und", "aa", "ee", "é", "aa"]
    assert found[7].lang_pred in SAMPLES
    assert [r.score for r in found[:3]] == [0, 0, 0] and all(0 < r.score <= 1 for r in found[3:])


def test_remembering_changes_nothing(spark, network, monkeypatch):
    counts = language.Counter(language.words_of("banana zwerg banana père " * 9))
    remembered = language._Labels(network)
    remembered.learn(set(counts))
    monkeypatch.setattr(language, "REMEMBERED", 1)
    forgetful = language._Labels(network)
    for words in ({"sana"}, {"mala", "kala"}, set(counts)):
        forgetful.learn(words)
    assert np.allclose(remembered.pooled(counts), forgetful.pooled(counts))


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b", None), (2, None, "x")], SCHEMA + ", lang string")
    network = language.fit(docs)
    assert [r.lang_pred for r in language.predict(docs, network).collect()] == ["und", "und"]
    assert language.predict(docs.limit(0), network).count() == 0


def test_repeated_rows_and_other_columns(spark, network):
    docs = spark.createDataFrame([(1, "banana", 2.0, "q")] * 2 + [(None, "stern", 1.0, "q")], SCHEMA + ", score double, id string")
    found = [(r.id, r.lang_pred) for r in language.predict(docs, network).collect()]
    assert sorted(found, key=str) == [(1, "aa"), (1, "aa"), (None, "ee")]


GERMAN = "der die und schlecht zwerg stern gerste berg wald nicht ein haus strasse".split()
ENGLISH = "the and of thing with river house stone water light there which about".split()


def test_many_copies_take_no_language_away(spark):
    """Copies of one German text are a hundred times all the rest."""
    rows = [(n, " ".join(GERMAN[n % 7 : n % 7 + 5]) + f" wald{n}", "de") for n in range(40)]
    rows += [(n, " ".join(ENGLISH[n % 7 : n % 7 + 5]) + f" x{n}", "en") for n in range(600)]
    docs = spark.createDataFrame(rows, SCHEMA + ", lang string")
    copies = spark.range(60_000).selectExpr("id AS doc_id", "'der eine satz' AS text", "'de' AS lang")
    network = language.fit(docs.union(copies), steps=200)
    assert network.languages == ["de", "en"]
    found = language.predict(docs, network).collect()
    wanted = {r[1]: r[2] for r in rows}
    right = [r.lang_pred == wanted[row[1]] for r, row in zip(found, docs.collect(), strict=True)]
    assert np.mean(right) > 0.97


def test_the_sample_is_bounded_and_holds_each_language(spark, monkeypatch):
    taken = {}
    monkeypatch.setattr(language, "trained", lambda samples, steps: taken.update(samples))
    rows = [(n, f"{lang}{n % 500}", lang) for lang in ("aa", "bb") for n in range(1000)]
    rows += [(1, "cc", "cc"), (2, None, "dd"), (3, "1 2", "ee")]
    language.fit(spark.createDataFrame(rows, SCHEMA + ", lang string"), sample_docs=50)
    assert {lang: len(words) for lang, words in taken.items()} == {"aa": 50, "bb": 50, "cc": 1}


def test_fold_is_the_checksum_of_the_id(spark):
    rows = spark.createDataFrame([(n,) for n in (0, 7, 12345, None)], "id long")
    found = [r[0] for r in rows.select(language.fold(F.col("id"), 4)).collect()]
    assert found == [zlib.crc32(str(n).encode()) % 4 for n in (0, 7, 12345)] + [None]


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang", "text")
    found = QUERIES["op9_language_id"](spark, folder).join(truth, "doc_id").collect()
    held_out = [r for r in found if r.held_out]
    assert {r.doc_id for r in held_out} == {r.doc_id for r in found if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    assert np.mean([r.lang_pred == r.lang for r in held_out]) >= 0.97
