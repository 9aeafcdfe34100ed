"""Joins and NULL handling on tables that are made up at random."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from larderline.operators import nulls
from larderline.operators.joins import many_to_many

FEW = settings(
    max_examples=8,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)

keys = st.sampled_from(["a", "a", "a", "b", "c", None])
side = st.lists(st.tuples(keys, st.integers(0, 3)), max_size=40)
cell = st.one_of(st.none(), st.floats(allow_nan=True))
table = st.lists(st.tuples(cell, st.one_of(st.none(), st.text(max_size=3))), max_size=20)


def sorted_rows(df):
    return sorted(map(repr, df.collect()))


@FEW
@given(left=side, right=side, pairs_per_task=st.sampled_from([1, 7, 50]))
def test_grid_join_is_the_join(spark, left, right, pairs_per_task):
    lefts = spark.createDataFrame(left, "k string, l int")
    rights = spark.createDataFrame(right, "k string, r int")
    spread = many_to_many(lefts, rights, "k", pairs_per_task)
    assert sorted_rows(spread) == sorted_rows(lefts.join(rights, "k"))


@FEW
@given(rows=table)
def test_drop_is_dropna(spark, rows):
    df = spark.createDataFrame(rows, "d double, s string")
    assert sorted_rows(nulls.drop_null_rows(df)) == sorted_rows(df.dropna())
