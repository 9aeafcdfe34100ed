"""The session settings and the shared folder that jobs write under."""

from __future__ import annotations

import atexit
import contextlib
import functools
import math
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession

SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a heavy join key even where a later step then needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # If a lost map task comes out differently when it runs again, run all tasks
    # that read it again as well.
    "spark.sql.shuffle.orderIndependentChecksum.enabled": "true",
    "spark.sql.shuffle.orderIndependentChecksum.enableFullRetryOnMismatch": "true",
    # Use what the catalog knows of analyzed tables.
    "spark.sql.cbo.enabled": "true",
    # Keep stream state on disk; it outgrows the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Both sides of a stream join in one store.
    "spark.sql.streaming.join.stateFormatVersion": "3",
    "spark.ui.enabled": "false",
}


# Bounds for the size and the number of tasks.
SPLIT_BYTES = 128 * 2**20
SHUFFLE_BYTES = 256 * 2**20
MOST_TASKS = 100_000
# Rows in a shuffle take about this many times their bytes in a Parquet file.
UNPACKED = 2
# Jobs sort and compare rows, which then take some twenty times their bytes in a
# file, and in several steps of a task at once. So their tasks are smaller while
# there are few of them.
HELD_BYTES = 8 * 2**20
FEW_TASKS = 8192
# What AQE merges small partitions to, if not told otherwise.
MERGED_BYTES = 64 * 2**20
# Spark's estimate for a source whose size it cannot tell.
NO_SIZE = 2**63 - 1


def apply_settings(spark: SparkSession) -> None:
    """Give a session that was built elsewhere the settings the jobs count on."""
    for key, value in SESSION_SETTINGS.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)


def build_session(app_name: str, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SESSION_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def task_sizes(input_bytes: int, cores: int) -> dict[str, str]:
    """Settings that fit scans and shuffles to the size of the input.

    Splits and shuffle partitions keep their usual size while their number is
    reasonable, and grow beyond that, because each shuffle keeps a block per
    pair of tasks. Too many partitions do no harm: AQE merges small ones.
    """
    shuffled = math.ceil(input_bytes * UNPACKED / SHUFFLE_BYTES)
    return {
        "spark.sql.files.maxPartitionBytes": str(
            max(SPLIT_BYTES, math.ceil(input_bytes / MOST_TASKS))
        ),
        "spark.sql.shuffle.partitions": str(min(max(shuffled, cores), MOST_TASKS)),
    }


def job_sizes(input_bytes: int, cores: int) -> dict[str, str]:
    """Settings that keep small what a task of a job holds: smaller splits and
    partitions than ``task_sizes``, and none merged beyond that, until there are
    ``FEW_TASKS``. From there they grow to the usual size."""
    sizes = task_sizes(input_bytes, cores)
    held = max(HELD_BYTES, math.ceil(input_bytes / FEW_TASKS))
    splits, partitions = "spark.sql.files.maxPartitionBytes", "spark.sql.shuffle.partitions"
    if 2 * held < SPLIT_BYTES:
        sizes[splits] = str(2 * held)
    sizes[partitions] = str(max(int(sizes[partitions]), math.ceil(input_bytes / held)))
    sizes["spark.sql.adaptive.advisoryPartitionSizeInBytes"] = str(min(held, MERGED_BYTES))
    return sizes


def _scanned_bytes(rows: DataFrame) -> int:
    """What the sources of a plan hold, as Spark estimates it. Sources that give
    no size, such as a database, count as nothing."""
    leaves = rows._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(n).stats().sizeInBytes()) for n in range(leaves.size())]
    return sum(size for size in sizes if size < NO_SIZE)


def prepare(spark: SparkSession, *inputs: DataFrame) -> None:
    """Make a session ready for a job over the inputs: settings and task sizes."""
    apply_settings(spark)
    input_bytes = sum(_scanned_bytes(rows) for rows in inputs)
    for key, value in job_sizes(input_bytes, spark.sparkContext.defaultParallelism).items():
        spark.conf.set(key, value)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """What the files below the path hold; nothing if there are none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getContentSummary(folder).getLength() if files.exists(folder) else 0


def fit_tasks(spark: SparkSession, *paths: str) -> None:
    """Fit the session to the files below the paths."""
    input_bytes = sum(stored_bytes(spark, path) for path in paths)
    sizes = task_sizes(input_bytes, spark.sparkContext.defaultParallelism)
    for key, value in sizes.items():
        spark.conf.set(key, value)


@functools.cache
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="larderline-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    # All tasks of this master run in this process; those of local-cluster do not.
    if re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        return _local_folder()
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def new_run_folder(spark: SparkSession, purpose: str) -> str:
    """A path under the shared folder that no other run uses. It goes when the
    driver ends."""
    runs = f"{shared_folder(spark)}/larderline/{spark.sparkContext.applicationId}"
    if runs not in _KEPT_UNTIL_EXIT:
        _KEPT_UNTIL_EXIT.add(runs)
        folder = spark._jvm.org.apache.hadoop.fs.Path(runs)
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        atexit.register(_drop_at_exit, files, folder)
    return f"{runs}/{purpose}-{uuid.uuid4().hex[:12]}"


# Folders of the runs of an application, which go when its driver ends.
_KEPT_UNTIL_EXIT: set[str] = set()


def _drop_at_exit(files: object, folder: object) -> None:
    # Nothing can be removed if the JVM has ended first.
    with contextlib.suppress(Exception):
        files.delete(folder, True)


def folders_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder; none if it is not there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    return [status.getPath().getName() for status in files.listStatus(folder)]


def drop_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextlib.contextmanager
def staged(rows: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """The rows, written to the shared folder for as long as the block runs."""
    spark = rows.sparkSession
    path = new_run_folder(spark, purpose)
    try:
        rows.write.parquet(path)
        yield spark.read.schema(rows.schema).parquet(path)
    finally:
        drop_folder(spark, path)


def newest_complete(spark: SparkSession, folders: Sequence[str]) -> str | None:
    """The folder whose last Spark write finished latest, if any did."""
    finished = {}
    for folder in folders:
        marker = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
        files = marker.getFileSystem(spark._jsc.hadoopConfiguration())
        if files.exists(marker):
            finished[folder] = files.getFileStatus(marker).getModificationTime()
    return max(finished, key=finished.get, default=None)


def remembered(spark: SparkSession, path: str, compute: Callable[[], DataFrame]) -> DataFrame:
    """The table at ``path``, computed and written there the first time."""
    if newest_complete(spark, [path]) is None:
        compute().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
