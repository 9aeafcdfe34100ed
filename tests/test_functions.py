"""Column expressions on the values where they could go wrong."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from larderline.functions import labels, text, times


def values(spark, column, rows, kind="string"):
    df = spark.createDataFrame([(row,) for row in rows], f"x {kind}")
    return [row[0] for row in df.select(column(F.col("x"))).collect()]


@pytest.fixture
def zone(spark):
    """Run a test in a zone with clock changes."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield
    spark.conf.set("spark.sql.session.timeZone", before)


def test_stock_flag_bounds(spark):
    flags = values(spark, labels.stock_flag, [0, -3, 19, 20, None], "int")
    assert flags == ["Out of stock", "Low stock", "Low stock", "In stock", "In stock"]


def test_stock_flag_names_a_missing_level(spark):
    flags = values(spark, lambda x: labels.stock_flag(x, "Unknown"), [None, 50], "int")
    assert flags == ["Unknown", "In stock"]


def test_first_status_fragment_decides(spark):
    statuses = ["unship cancelled", "reshipping", "ordered", "out for delivery", None]
    expected = ["cancelled", "shipped", "ordered", "delivered", None]
    assert values(spark, labels.order_status, statuses) == expected


def test_status_families_are_fixed_points(spark):
    families = [label for _, label in labels.STATUS_BY_FRAGMENT]
    assert values(spark, labels.order_status, families) == families


def test_trim_takes_spaces_only(spark):
    assert values(spark, text.standardized, ["\tA\t", "  B ", None]) == ["\ta\t", "b", None]


def test_snake_case_keeps_camel_case_together():
    assert [text.snake_case(n) for n in ("Order ID", "orderTs")] == ["order_id", "orderts"]


def test_courier_id_is_padded_but_never_cut(spark):
    ids = values(spark, text.courier_id, [7, 42, 1000], "bigint")
    assert ids == ["C007", "C042", "C1000"]


def test_order_value_is_exact_beyond_ten_digits(spark):
    df = spark.createDataFrame(
        [(3, Decimal("19.99")), (2_000_000, Decimal("99999999.99"))], "q int, p decimal(10,2)"
    )
    worth = df.select(labels.order_value(F.col("q"), F.col("p"))).collect()
    assert [row[0] for row in worth] == [Decimal("59.97"), Decimal("199999999980000.00")]


def test_epoch_is_exact_at_the_clock_change(spark, zone):
    moments = values(spark, times.epoch_to_timestamp, ["1762061400", "1762065000"])
    assert moments == [dt.datetime(2025, 11, 2, 5, 30), dt.datetime(2025, 11, 2, 6, 30)]


def test_epoch_text_that_is_no_second_gives_null(spark):
    moments = values(spark, times.epoch_to_timestamp, ["soon", "", None, "99999999999999", "12.5"])
    assert moments == [None] * 5


def test_epoch_and_back(spark, zone):
    seconds = [0, 1762065000, 1741503600, 4102444800]
    back = values(
        spark, lambda x: times.timestamp_to_epoch(times.epoch_to_timestamp(x)), seconds, "bigint"
    )
    assert back == seconds


def test_iso_text_loses_its_letters_and_zone(spark, zone):
    moments = values(
        spark, times.iso_to_timestamp, ["2025-07-01T08:00:00Z", "2025-07-01 08:00:00", "never"]
    )
    assert moments == [dt.datetime(2025, 7, 1, 8), dt.datetime(2025, 7, 1, 8), None]
