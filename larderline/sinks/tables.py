"""Write tables to Parquet folders, databases and warehouse connectors."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Names the sub-folder of a value: ``v`` and the value, or ``none``. A folder
# named by the value alone would not tell an empty text from none, nor 007 from 7.
_FOLDER = "cluster_folder"
_RUN = "run_id"


def _folder_of(value: Column) -> Column:
    return F.coalesce(F.concat(F.lit("v"), value.cast("string")), F.lit("none"))


def write_clustered(rows: DataFrame, path: str, cluster_by: str | None = None) -> None:
    """Replace the folder, in sub-folders per value of ``cluster_by`` if given.

    Rows of one value are brought together first, or each task would leave a
    small file in every sub-folder. Rebalancing, unlike a repartition, splits
    values that hold too many rows for one task.
    """
    if cluster_by is None:
        rows.write.mode("overwrite").parquet(path)
    else:
        together = rows.hint("rebalance", cluster_by)
        named = together.withColumn(_FOLDER, _folder_of(F.col(cluster_by)))
        named.write.mode("overwrite").partitionBy(_FOLDER).parquet(path)


def read_clustered(
    spark: SparkSession, path: str, only: Sequence[object] | None = None
) -> DataFrame:
    """What ``write_clustered`` wrote, with the values and types it had. Of some
    values ``only``, no other sub-folder is read."""
    rows = _with_text(spark, path, _FOLDER)
    if only is not None:
        folders = ["none" if value is None else f"v{value}" for value in only]
        rows = rows.filter(F.col(_FOLDER).isin(folders))
    return rows.drop(_FOLDER)


def _with_text(spark: SparkSession, path: str, column: str) -> DataFrame:
    """The table, the named folder column read as the text it is."""
    found = spark.read.parquet(path).schema
    declared = [
        T.StructField(field.name, T.StringType() if field.name == column else field.dataType)
        for field in found
    ]
    return spark.read.schema(T.StructType(declared)).parquet(path)


def append_run(rows: DataFrame, path: str, run_id: str) -> None:
    """Add the rows of one run. The run owns a sub-folder, so running it again
    replaces its rows instead of adding them twice."""
    if not re.fullmatch(r"[\w.-]+", run_id):
        raise ValueError(f"a run id has letters, digits and ._- only, not {run_id!r}")
    rows.write.mode("overwrite").parquet(f"{path}/{_RUN}={run_id}")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all runs, with the run id as it was given."""
    return _with_text(spark, path, _RUN)


def write_jdbc(
    rows: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str],
    connections: int = 8,
    batch_rows: int = 10_000,
) -> None:
    """Append to a database table over a bounded number of connections.

    Each connection commits on its own. Load only ``new_rows`` of the key, and
    a second run after a failure completes the first.
    """
    (
        rows.write.mode("append")
        .option("numPartitions", connections)
        .option("batchsize", batch_rows)
        .jdbc(url, table, properties=dict(properties))
    )


def write_connector(
    rows: DataFrame, connector: str, options: Mapping[str, str], mode: str = "overwrite"
) -> None:
    """Write through a connector the cluster provides, such as a document store
    or a cloud warehouse."""
    rows.write.format(connector).options(**options).mode(mode).save()
