from __future__ import annotations

import random
import re

import duckdb
import numpy as np
import pytest

from larderline.llm import decontaminate, sql

DOCS = "doc_id long, text string"
ITEMS = "item_id long, text string"


def words_in(text):
    return re.findall(r"\w+", (text or "").lower())


def shingles(text, size=5):
    words = words_in(text)
    return {tuple(words[at : at + size]) for at in range(len(words) - size + 1)}


def plain(docs, items):
    found = []
    for doc_id, text in docs:
        for item_id, item in dict.fromkeys(items):
            size = min(5, len(words_in(item)))
            wanted = shingles(item, size) if size else set()
            shared = len(shingles(text, size) & wanted)
            if wanted and shared >= 0.8 * len(wanted):
                found.append((doc_id, item_id, len(wanted), shared))
    return found


def search(spark, docs, items, **options):
    found = decontaminate.contained_items(
        spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), **options
    )
    return [(r.id, r.item_id, r.n_shingles, r.n_shared) for r in found.collect()]


def tables():
    """Items of all sizes, whole, cut short or changed, inside texts of all sizes."""
    draw = random.Random(8)
    pool = [f"w{n}" for n in range(3000)]
    sizes = [5, 6, 7, 9, 12, 17, 25, 40, 70, 150, 400]
    items = [(n, " ".join(draw.choices(pool, k=size))) for n, size in enumerate(sizes * 3)]
    items += [(90, None), (91, ""), (92, "only four words here"), (93, items[3][1]), (None, items[5][1])]
    docs = [(None, items[4][1]), (1, None), (2, ""), (3, "only four words here"), (4, "a b c d e")]
    for n in range(300):
        words = draw.choices(pool, k=draw.choice((3, 30, 300, 3000)))
        item = items[n % len(sizes * 3)][1].split()
        kept = item[: max(1, round(len(item) * draw.choice((0.5, 0.8, 0.85, 1))))]
        if n % 4 == 0:
            kept[draw.randrange(len(kept))] = "changed"
        at = draw.randrange(len(words))
        docs.append((100 + n, " ".join([*words[:at], *kept, *words[at:]])))
    docs += [(800 + n, f"x {text} y") for n, text in enumerate(["Only four, words here", "only four words", "w7"])]
    items += [(94, "W7"), (95, "w1 w2"), (95, "w1 w2")]
    docs += [(100, docs[5][1]), (900, " ".join(draw.choices(pool, k=60_000) + items[7][1].upper().split()))]
    return docs, items


@pytest.mark.parametrize("block_chars", [decontaminate.BLOCK_CHARS, 2000])
def test_finds_all_that_comparing_all_finds(spark, block_chars):
    docs, items = tables()
    wanted = plain(docs, items)
    assert len(wanted) > 90
    assert sorted(search(spark, docs, items, block_chars=block_chars), key=repr) == sorted(wanted, key=repr)


def test_case_and_punctuation_do_not_hide_an_item(spark):
    docs = [(1, "x ONE, two; (three)\nfour... five! y"), (2, "one two three x four five")]
    assert search(spark, docs, [(7, "One two three four five")]) == [(1, 7, 1, 1)]


def test_common_words_and_repeats_make_no_item(spark):
    items = [(n, f"the quick brown fox jumps over dog number {n} of all the dogs there are") for n in range(50)]
    docs = [(n, "the quick brown fox jumps over " * 40) for n in range(30)]
    assert search(spark, docs, items) == []


def test_clean_documents_stay_whole(spark):
    docs, items = tables()
    rows = [(i, t, f"w{n}", n) for n, (i, t) in enumerate(docs)]
    frame = spark.createDataFrame(rows, DOCS + ", item_id string, row int")
    dirty = {doc_id for doc_id, *_ in plain(docs, items)}
    kept = decontaminate.drop_contaminated(frame, spark.createDataFrame(items, ITEMS))
    assert kept.columns == frame.columns
    # A document that shares its id with a dirty one is judged by its own text.
    wanted = [r for r in rows if not plain([r[:2]], items)]
    assert len(dirty) < len(rows)
    assert sorted(map(tuple, kept.collect()), key=lambda r: r[3]) == wanted


def test_empty_tables(spark):
    assert search(spark, [], [(1, "a b c d e f")]) == []
    assert search(spark, [(1, "a b c d e f")], []) == []


def test_bins_keep_the_chance_of_a_miss_small():
    draw = np.random.default_rng(1)
    for size in (1, 4, 20, 100):
        exponent = decontaminate.bins_per_shingle(size)
        load = 2.0**-exponent
        least = -np.expm1(-load) / load
        assert least == 1 or size * np.log1p(-least) <= np.log(decontaminate.MISS)
    # More shingles to find make do with fewer bins.
    assert decontaminate.bins_per_shingle(4) > decontaminate.bins_per_shingle(100)
    hashes = np.unique(draw.integers(0, 2**64, 1000, dtype=np.uint64))
    index = decontaminate.ItemIndex(["one two three four five"], 0.8)
    assert len(index.candidates(hashes)) == 0


def test_items_in_scripts_without_blanks_are_found(spark):
    items = [(1, "中国的首都是哪个城市？"), (2, "日本で一番高い山はなんですか"), (3, "ประเทศไทยมีกี่จังหวัด"), (4, "the capital of 中国的首都 is")]
    docs = [(n, f"Question {n}：{text} and an answer") for n, text in items]
    docs += [(9, "中国的城市很多，日本的山也很高"), (10, "中国 的 首都 x 是哪个"), (11, None)]
    found = search(spark, docs, items)
    assert sorted((doc_id, item_id) for doc_id, item_id, *_ in found) == [(n, n) for n, _ in items]
    assert decontaminate.words_of("Ab_1 中国x") == ["ab_1", "中", "国", "x"]


def test_items_of_few_words_are_found_in_a_row(spark):
    items = [(1, "alpha beta gamma delta"), (2, "中国"), (3, "delta"), (4, "gamma alpha")]
    docs = [(1, "x Alpha, beta gamma-delta y"), (2, "alpha beta gamma x delta"), (3, "中 国"), (4, "在中国。")]
    found = search(spark, docs, items)
    assert sorted(found) == [(1, 1, 1, 1), (1, 3, 1, 1), (2, 3, 1, 1), (3, 2, 1, 1), (4, 2, 1, 1)]


def test_sql_knows_short_items_and_scripts_without_blanks(spark):
    items = [(1, "中国的首都是哪个城市？"), (2, "日本で一番高い山"), (3, "ประเทศไทยมีกี่จังหวัด"), (4, "the capital of 中国的首都 is")]
    items += [(5, "alpha beta"), (6, "中国"), (7, None), (8, ""), (8, ""), (9, "Ab_1 中国x")]
    docs = [(n, f"Question {n}：{text} and an answer") for n, text in items]
    docs += [(30, "alpha 中国 beta"), (31, "ALPHA beta"), (32, None)]
    connection = duckdb.connect()
    for name, key, rows in (("documents", "doc_id", docs), ("benchmark", "item_id", items)):
        connection.execute(f"CREATE TABLE {name} ({key} BIGINT, text VARCHAR)")
        connection.executemany(f"INSERT INTO {name} VALUES (?, ?)", rows)
    wanted = connection.execute(sql.DECONTAMINATION).fetchall()
    assert sorted(search(spark, docs, items)) == sorted(wanted)
    assert {(n, n) for n in (1, 2, 3, 4, 5, 6, 9)} <= {row[:2] for row in wanted}


def test_items_that_are_not_searched_for_are_told(spark):
    items = [(1, "中国的首都是哪个城市？"), (2, "four words are few"), (3, None), (4, "...")]
    rows = decontaminate.not_searched(spark.createDataFrame(items, ITEMS)).collect()
    assert sorted(r.item_id for r in rows) == [3, 4]
