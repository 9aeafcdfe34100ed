"""Look at a table: its columns, its size, a few of its rows."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NESTED = (T.StructType, T.ArrayType, T.MapType)


def nested_columns(schema: T.StructType) -> list[str]:
    return [field.name for field in schema if isinstance(field.dataType, NESTED)]


def require_flat(df: DataFrame) -> DataFrame:
    """Return ``df`` if no column holds a struct, an array or a map."""
    nested = nested_columns(df.schema)
    if nested:
        raise ValueError(f"nested columns: {nested}")
    return df


def require_flat_texts(df: DataFrame) -> DataFrame:
    """Rows of text columns; a text that is a JSON object or array, which is how
    a nested value arrives in a text column, fails the job that reads it."""
    nested = [
        F.when(
            F.json_array_length(f"`{name}`").isNotNull()
            | F.json_object_keys(f"`{name}`").isNotNull(),
            F.lit(name),
        )
        for name in df.columns
    ]
    names = F.concat_ws(",", *nested)
    message = F.concat(F.lit("nested values in "), names)
    return df.filter(F.assert_true(names == "", message).isNull())


def describe_columns(df: DataFrame) -> DataFrame:
    """Position, name, type, nesting and number of NULLs of each column, in one
    pass over the table."""
    nested = set(nested_columns(df.schema))
    counts = df.agg(
        *[F.count_if(F.col(f"`{name}`").isNull()).alias(name) for name in df.columns]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(position).alias("position"),
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("data_type"),
                F.lit(field.name in nested).alias("is_nested"),
                F.col(f"`{field.name}`").alias("null_rows"),
            )
            for position, field in enumerate(df.schema, start=1)
        ]
    )
    return counts.select(F.inline(rows))


def row_counts(**tables: DataFrame) -> DataFrame:
    """One row per table with its number of rows."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return functools.reduce(DataFrame.unionByName, counts)


def sample(df: DataFrame, rows: int = 10) -> DataFrame:
    """Any few rows, for looking at."""
    return df.limit(rows)
