"""Write source-shaped files: CSV with a header, JSON documents."""

from __future__ import annotations

from pyspark.sql import DataFrame

from larderline.sources.files import CSV_DIALECT


def append_csv(rows: DataFrame, path: str) -> None:
    """Add rows as CSV files that each start with a header. Blanks, quotes, line
    breaks and empty texts come back as they went; a missing value is written
    as nothing between separators."""
    options = {**CSV_DIALECT, "nullValue": ""}
    rows.write.mode("append").options(**options).csv(path)


def write_documents(rows: DataFrame, path: str) -> None:
    """One JSON document per line; NULL fields are left out."""
    rows.write.mode("overwrite").json(path)
