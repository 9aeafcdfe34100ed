"""What several operators share: words, stored steps, size checks."""

from __future__ import annotations

import io
import pathlib
import zipfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import larderline
from larderline.workspace import new_run_folder

# ASCII blanks: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"

# Rows of a table that may be broadcast; beyond it Spark joins by shuffle.
BROADCAST_ROWS = 200_000


# Applications whose Python workers have been given this package.
_EQUIPPED: set[str] = set()


def equip(spark: SparkSession) -> None:
    """Give this package to the application's Python workers, through the shared
    folder, so that they need not have it installed. Done once."""
    context = spark.sparkContext
    if context.applicationId in _EQUIPPED:
        return
    content = io.BytesIO()
    root = pathlib.Path(larderline.__file__).parent
    with zipfile.ZipFile(content, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    path = f"{new_run_folder(spark, 'package')}/larderline.zip"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    stream.write(bytearray(content.getvalue()))
    stream.close()
    context.addPyFile(path)
    _EQUIPPED.add(context.applicationId)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` worked out once however often it is used."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The runs of characters between ASCII blanks; none for NULL."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, BLANK_RUN)
    )


def store(rows: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """The rows, written once to the shared folder and read from there, and the
    path, for steps that replace the table and drop it.

    It cuts lineage, so a lost executor costs no more than the reader's task.
    """
    path = new_run_folder(rows.sparkSession, purpose)
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path), path


def stored(rows: DataFrame, purpose: str) -> DataFrame:
    """The rows, written once to the shared folder and read from there."""
    return store(rows, purpose)[0]


def broadcast_if_small(table: DataFrame, most_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A stored table with a broadcast hint if its counted rows allow it."""
    small = table.limit(most_rows + 1).count() <= most_rows
    return F.broadcast(table) if small else table
