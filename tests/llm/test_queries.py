"""The registered queries and the pipeline, on the test tables and on small ones."""

from __future__ import annotations

import zlib

import corpus_pipeline
import duckdb
import numpy as np
import public_tokenizers
import pytest
import test_decontaminate
import test_line_chunks
import test_quality
import test_simhash
from tokenizers import Tokenizer

from larderline.llm.queries import QUERIES, SQL

NAMES = [f"op{n}_" for n in range(1, 14)]


def expected(tables, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tables}/{table}.parquet'")
    result = connection.execute(SQL[name])
    return [column[0] for column in result.description], result.fetchall()


def test_there_is_a_query_for_each_operator():
    assert [sum(name.startswith(own) for name in QUERIES) for own in NAMES] == [1] * 13
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, tables, name):
    found = QUERIES[name](spark, tables)
    columns, rows = expected(tables, name)
    assert sorted(found.columns) == sorted(columns)
    got = sorted((tuple(r[c] for c in columns) for r in found.collect()), key=repr)
    assert got == sorted(rows, key=repr)


COLUMNS = {
    "op2_": ["doc_id", "held_out", "score", "predicted"],
    "op3_": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    "op4_": ["doc_id", "text"],
    "op5_": ["doc_id", "fingerprint", "component_id"],
    "op6_": ["page_id", "host", "path", "rule", "verdict"],
    "op8_": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op9_": ["doc_id", "held_out", "lang_pred", "score"],
}


@pytest.mark.parametrize("own", sorted(COLUMNS))
def test_returns_a_row_for_each_of_the_table(spark, tables, own):
    (name,) = [name for name in QUERIES if name.startswith(own)]
    found = QUERIES[name](spark, tables)
    assert set(COLUMNS[own]) <= set(found.columns)
    key = COLUMNS[own][0]
    table = "pages" if key == "page_id" else "documents"
    ids = [r[0] for r in spark.read.parquet(f"{tables}/{table}.parquet").select(key).collect()]
    rows = found.collect()
    firsts = [r for r in rows if r.piece == 0] if own == "op8_" else rows
    assert sorted(r[key] for r in firsts) == sorted(ids)


def plain_pipeline(rows, items):
    """Kept ``(doc_id, text)`` after each stage but the last, one by one."""
    stages = []
    rows = [(i, t) for i, t in rows if plainly_good(t)]
    stages.append(rows)
    cleaned = test_line_chunks.plain_cleaned(rows)
    rows = [(i, cleaned[i, t]) for i, t in rows if cleaned[i, t].strip() or cleaned[i, t] == t]
    stages.append(rows)
    groups = test_simhash.plain_groups(rows)
    rows = [row for row, (_, least) in zip(rows, groups, strict=True) if row[0] == least]
    stages.append(rows)
    rows = [row for row in rows if not test_decontaminate.plain([row], items)]
    stages.append(rows)
    return stages


def plainly_good(text):
    """All hosts of the test table are bad: no minor failure is forgiven."""
    n, chars, symbols, repeated = test_quality.plain_measures(text)
    lines = [line for line in text.split("\n") if line.strip()]
    dup = len(lines) - len(set(lines))
    return not (
        n < 10
        or 100 * repeated > 20 * n
        or not 2 * n <= chars <= 15 * n
        or 100 * symbols > 10 * n
        or 100 * dup > 30 * (text.count("\n") + 1)
    )


def test_pipeline_is_its_stages_one_by_one(spark, tables):
    documents = spark.read.parquet(f"{tables}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{tables}/benchmark.parquet").select("item_id", "text").collect()]
    rows = sorted((r.doc_id, r.text) for r in documents.collect())
    docs = documents
    for (name, stage), wanted in zip(corpus_pipeline.STAGES[:-1], plain_pipeline(rows, items), strict=True):
        docs = corpus_pipeline.stored(stage(spark, docs, tables), name)
        assert docs.columns == documents.columns
        assert sorted((r.doc_id, r.text) for r in docs.collect()) == wanted, name
        assert all(r.n_chars == len(r.text) for r in docs.collect())
        assert 0 < len(wanted)
    packed = corpus_pipeline.run(spark, tables).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = dict(wanted)
    assert {r.doc_id for r in packed} == set(texts)
    for doc_id, text in texts.items():
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [2]
        own = sorted((r for r in packed if r.doc_id == doc_id), key=lambda r: r.piece)
        whole = b"".join(r.ids for r in own)
        assert zlib.crc32(whole) == zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_pipeline_of_no_documents(spark, tables, tmp_path):
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{tables}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
