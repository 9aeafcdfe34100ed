"""Rows with missing values: report them, drop them or fill them."""

from __future__ import annotations

import functools
import operator
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What stands in for a missing value.
ORDER_DEFAULTS = {"quantity": 0, "price": 0.0, "status": "unknown"}
INVENTORY_DEFAULTS = {"category": "unknown", "warehouse": "unknown", "stock_level": 0}

NULL_POLICIES = ("drop", "fill")


def _is_present(name: str, kind: str) -> Column:
    value = F.col(f"`{name}`")
    if kind in ("float", "double"):
        return value.isNotNull() & ~F.isnan(value)
    return value.isNotNull()


def has_null(df: DataFrame) -> Column:
    """Whether any column of a row is NULL."""
    missing = [F.col(f"`{name}`").isNull() for name in df.columns]
    return functools.reduce(operator.or_, missing)


def null_rows(df: DataFrame) -> DataFrame:
    """Rows with a NULL in any column."""
    return df.filter(has_null(df))


def drop_null_rows(df: DataFrame) -> DataFrame:
    """Rows without NULL or NaN.

    Same rows as ``df.dropna()``, but as one IS NOT NULL test per column, which
    file sources can use to skip data; ``dropna`` is opaque to them.
    """
    present = [_is_present(name, kind) for name, kind in df.dtypes]
    return df.filter(functools.reduce(operator.and_, present))


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace NULL by the column's default; names match in any case."""
    return df.fillna(dict(defaults))


def apply_null_policy(df: DataFrame, policy: str, defaults: Mapping[str, object]) -> DataFrame:
    """``drop`` removes every incomplete row. ``fill`` first gives the columns
    that have a default their default, then drops what is still incomplete."""
    if policy not in NULL_POLICIES:
        raise ValueError(f"null policy must be one of {NULL_POLICIES}, not {policy!r}")
    if policy == "fill":
        df = fill_defaults(df, defaults)
    return drop_null_rows(df)
