from __future__ import annotations

import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from larderline.llm import toxicity

DOCS = "doc_id long, text string"
LABELS = "doc_id long, toxic int"


def plain_segments(scores):
    """Maximal segments by their definition: the best segment of the whole, the
    shortest of equal ones, then the same to its left and right."""
    best = None
    for first in range(len(scores)):
        for last in range(first, len(scores)):
            total = sum(scores[first : last + 1])
            if total > 0 and (best is None or (total, first - last) > (best[2], best[0] - best[1])):
                best = (first, last, total)
    if best is None:
        return []
    first, last, total = best
    right = [(a + last + 1, b + last + 1, t) for a, b, t in plain_segments(scores[last + 1 :])]
    return [*plain_segments(scores[:first]), best, *right]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([-7, -5, -3, -1, 1, 2, 4, 8]), max_size=24), st.randoms())
def test_segments_are_maximal(steps, draw):
    # Small fractions, all different, leave no ties.
    scores = [step + draw.randrange(1, 10**6) / 2**24 for step in steps]
    found = toxicity.maximal_segments(np.array(scores))
    wanted = plain_segments(scores)
    assert [(s.first, s.last) for s in found] == [(a, b) for a, b, _ in wanted]
    assert np.allclose([s.score for s in found], [t for _, _, t in wanted])


def test_segments_of_a_long_text_in_linear_time():
    draw = np.random.default_rng(1)
    scores = draw.choice([-1.0, 0.9], size=400_000)
    found = toxicity.maximal_segments(scores)
    assert sum(s.last - s.first + 1 for s in found) <= len(scores)
    falling = np.where(np.arange(400_000) % 2, -1.0, 1.0 - np.arange(400_000) / 1e6)
    assert len(toxicity.maximal_segments(falling)) == 200_000


def tables(spark):
    """Toxic texts have a few bad words together, some only with a bad stem."""
    draw = random.Random(5)
    plain = [f"word{chr(97 + n % 26)}{chr(97 + n // 26)}" for n in range(400)]
    bad = ["vileone", "viletwo", "vilethree", "nasty"] + [f"curs{chr(97 + n)}" for n in range(26)]
    rows, labels, truth = [], [], {}
    for n in range(1500):
        words = draw.choices(plain, k=draw.choice((5, 40, 400)))
        truth[n] = int(n % 6 == 0)
        if truth[n]:
            at = draw.randrange(len(words))
            words[at:at] = draw.choices(bad, k=4)
        rows.append((n, " ".join(words)))
        if n % 5:
            labels.append((n, truth[n]))
    copies = [(5000 + n, rows[7][1]) for n in range(400)]
    labels += [(5000 + n, 0) for n in range(400)]
    odd = [(9000, None), (9001, ""), (9002, "12 !"), (None, "nasty nasty vileone"), (9003, "wordaa " * 90_000 + "nasty vileone curse nasty")]
    return rows + copies + odd, [*labels, (6, 1), (None, 1), (12345, 1), (9001, None)], truth


def scored(spark, rows, labels):
    docs, known = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)
    found = toxicity.score_documents(docs, known, ~toxicity.held_out(F.col("doc_id")))
    return found.collect()


def test_held_out_documents_are_told_apart(spark):
    rows, labels, truth = tables(spark)
    found = scored(spark, rows, labels)
    assert len(found) == len(rows)
    by_id = {r.id: r for r in found}
    held_out = [n for n in truth if zlib.crc32(str(n).encode()) % 3 == 1]
    right = [by_id[n].predicted == truth[n] for n in held_out]
    assert np.mean(right) > 0.98
    assert {by_id[n].predicted for n in (9000, 9001, 9002, 5000)} == {0}
    assert by_id[9003].predicted == 1 and by_id[None].predicted == 1
    (passage,) = by_id[9003].passages
    assert passage.first >= 90_000
    assert all(0 < r.score < 1 or r.score == 1.0 for r in found)


def test_scores_of_many_tokens_come_by_a_join(spark):
    rows, labels, _ = tables(spark)
    docs, known = spark.createDataFrame(rows + rows[:3], DOCS), spark.createDataFrame(labels, LABELS)
    learn_from = ~toxicity.held_out(F.col("doc_id"))
    found = [
        toxicity.score_documents(docs, known, learn_from, held_tokens=n).collect()
        for n in (toxicity.MODEL_TOKENS, 0)
    ]
    # Sums over documents are added up in another order.
    shown = [
        sorted((str(r.id), r.n_words, r.predicted, round(r.score, 6), str(r.passages)) for r in rows)
        for rows in found
    ]
    assert shown[0] == shown[1]


def test_tokens_of_either_label_have_scores(spark):
    rows = [(f"bad{n % 3} both", 1) for n in range(60)] + [(f"good{n % 3} both", 0) for n in range(60)]
    model, known = toxicity.fit_scores(spark.createDataFrame(rows, "text string, toxic int"))
    assert model.scores["bad"] > 0 > model.scores["good"] and "both" not in model.scores
    assert {r.token: r.delta for r in known.collect()} == model.scores


def test_copies_are_learned_from_once(spark):
    docs = spark.createDataFrame([(n, "same text") for n in range(50)] + [(99, "other")], DOCS)
    labels = spark.createDataFrame([(n, 0) for n in range(50)] + [(0, 0), (99, 1)], LABELS)
    rows = toxicity.training_rows(docs, labels).collect()
    assert sorted((r.id, r.toxic) for r in rows) == [(0, 0), (99, 1)]


def test_without_labels_all_scores_are_low(spark):
    for labels in ([], [(1, 0)], [(1, 1)]):
        found = scored(spark, [(1, "some words"), (2, None), (2, None)], labels)
        assert [r.predicted for r in found] == [0, 0, 0]
    assert scored(spark, [], [(1, 1)]) == []


def test_other_columns_do_not_clash(spark):
    docs = spark.createDataFrame([(1, "a", 0.5, "s", 3)], DOCS + ", score double, id string, toxic int")
    labels = spark.createDataFrame([(1, 1, 0, "t")], LABELS + ", quality int, text string")
    found = toxicity.score_documents(docs, labels, F.col("doc_id") > 0).collect()
    assert [(r.id, r.n_words) for r in found] == [(1, 1)]
