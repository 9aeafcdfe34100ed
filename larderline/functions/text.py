"""Text columns and column names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def standardized(text: Column) -> Column:
    """Lower case without surrounding spaces; tabs and other blanks stay."""
    return F.lower(F.trim(text))


def snake_case(name: str) -> str:
    """``Order ID`` becomes ``order_id``; camel case is not split."""
    return name.lower().replace(" ", "_")


def courier_id(number: Column) -> Column:
    """``C`` and the number, padded with zeros to three digits at least."""
    digits = number.cast("string")
    width = F.greatest(F.lit(3), F.length(digits))
    return F.concat(F.lit("C"), F.lpad(digits, width, F.lit("0")))
