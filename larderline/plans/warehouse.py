"""The warehouse as a Spark schema of external Parquet tables.

Users of the tables query them with plain Spark SQL.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import uuid
from collections.abc import Collection, Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larderline.operators.inspection import row_counts
from larderline.plans.facts import courier_tracking, courier_tracking_within, orders_fact
from larderline.schemas import ORDERS, WAREHOUSE_TABLES, require
from larderline.workspace import drop_folder, folders_in, newest_complete, staged


TABLES = {"orders": ORDERS, **WAREHOUSE_TABLES}


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)


# Each table has two folders: one that is read, one for the next load.
FOLDERS = ("load-a", "load-b")
# Columns that the rows of a file are sorted by, so that a reader of some days
# skips the rest of it.
SORTED_BY = {"orders_dim": "order_date", "orders_fact": "order_date"}
# Tables that may be kept in a folder per day, by their day.
DAY_OF = {"orders_dim": "order_date", "orders_fact": "order_date"}
# Tables that grow by loads, each in a folder of its own, by the column that names
# it; the table has the folders of loads that were written whole.
LOAD_OF = {"orders": "load_id"}
# Columns by which a load is searched for some keys.
KEY_OF = {"orders": "order_id"}
# How Spark names the folder of rows without a value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def on_days(column: str, days: Collection[dt.date | None]) -> Column:
    """Whether the column has one of the days; NULL is told by None."""
    known = [day for day in days if day is not None]
    here = F.col(column).isin(known) if known else F.lit(False)
    return here | F.col(column).isNull() if None in days else F.coalesce(here, F.lit(False))


@contextlib.contextmanager
def _days_by_folder(spark: SparkSession) -> Iterator[None]:
    """Tables made now have the days whose folders are there, and no list of them
    in the catalog that would have to follow when a table is switched."""
    setting = "spark.sql.hive.manageFilesourcePartitions"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


class Warehouse:
    """A schema of tables below one root folder, written by one job at a time.

    Tables named in ``by_day`` are kept in a folder per day: some days can be
    replaced, and a reader of some days opens no file of the others.
    """

    def __init__(
        self, spark: SparkSession, database: str, root: str, by_day: Collection[str] = ()
    ):
        unknown = set(by_day) - set(DAY_OF)
        if unknown:
            raise ValueError(f"only {sorted(DAY_OF)} have days, not {sorted(unknown)}")
        self.spark = spark
        self.database = database
        self.root = root.rstrip("/")
        self.by_day = frozenset(by_day)

    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def table(self, table: str) -> DataFrame:
        rows = self.spark.table(self.name(table))
        # Spark puts the column of the folders last.
        if table in self.by_day or table in LOAD_OF:
            return rows.select(*TABLES[table].names)
        return rows

    def _folders(self, table: str) -> list[str]:
        return [f"{self.root}/{table}/{folder}" for folder in FOLDERS]

    def create(self) -> Warehouse:
        """The schema with every declared table that is not there yet, the
        orders landing table included. A table whose files an earlier session
        left under the root, without a catalog that remembers it, is found."""
        self.spark.sql(
            f"CREATE DATABASE IF NOT EXISTS `{self.database}` LOCATION '{self.root}'"
        )
        for table, schema in TABLES.items():
            if table in LOAD_OF:
                self._create_loads(table, schema)
                continue
            folders = self._folders(table)
            location = newest_complete(self.spark, folders) or folders[0]
            folders_of = f"PARTITIONED BY ({DAY_OF[table]})" if table in self.by_day else ""
            with _days_by_folder(self.spark):
                self.spark.sql(
                    f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({_columns(schema)}) "
                    f"USING parquet {folders_of} LOCATION '{location}'"
                )
        return self

    def _create_loads(self, table: str, schema: T.StructType) -> None:
        """The table with the loads that were written whole, by the mark that a
        write leaves last. What a lost job left is none."""
        location, column = f"{self.root}/{table}/loads", LOAD_OF[table]
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name(table)} "
            f"({_columns(schema)}, `{column}` string) "
            f"USING parquet PARTITIONED BY ({column}) LOCATION '{location}'"
        )
        for name in folders_in(self.spark, location):
            if newest_complete(self.spark, [f"{location}/{name}"]):
                self._add_load(table, name.removeprefix(f"{column}="))

    def _add_load(self, table: str, load_id: str) -> None:
        column = LOAD_OF[table]
        folder = f"{self.root}/{table}/loads/{column}={load_id}"
        self.spark.sql(
            f"ALTER TABLE {self.name(table)} ADD IF NOT EXISTS "
            f"PARTITION ({column} = '{load_id}') LOCATION '{folder}'"
        )

    def append_load(self, table: str, rows: DataFrame) -> None:
        """Add the rows as one load: all of them in one step, when the last one is
        written, or none. Filters of the key are kept with them, so that a search
        for some keys skips what cannot have them."""
        load_id = uuid.uuid4().hex
        folder = f"{self.root}/{table}/loads/{LOAD_OF[table]}={load_id}"
        writer = rows.select(*TABLES[table].names).write
        writer.option(f"parquet.bloom.filter.enabled#{KEY_OF[table]}", "true").parquet(folder)
        self._add_load(table, load_id)

    def _location(self, table: str) -> str:
        facts = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(table)}")
        return facts.filter(F.col("col_name") == "Location").first().data_type

    def replace(self, table: str, rows: DataFrame) -> None:
        """Give the table new content. The rows go to the folder that is not
        read and the table is switched to it when all are written, so a failed
        load leaves the old content and readers never see half a table. The old
        folder stays until the next load, for queries that still read it."""
        read_now = self._location(table).rsplit("/", 1)[-1]
        free = FOLDERS[1] if read_now == FOLDERS[0] else FOLDERS[0]
        location = f"{self.root}/{table}/{free}"
        require(rows, WAREHOUSE_TABLES[table])
        if table in self.by_day:
            self._write_days(table, rows, location, "static")
        else:
            if table in SORTED_BY:
                rows = rows.sortWithinPartitions(SORTED_BY[table])
            rows.write.mode("overwrite").parquet(location)
        self.spark.sql(f"ALTER TABLE {self.name(table)} SET LOCATION '{location}'")
        self.spark.catalog.refreshTable(self.name(table))

    def _write_days(self, table: str, rows: DataFrame, location: str, mode: str) -> None:
        """Days are brought together first, and a heavy one is split, or each task
        would leave a small file in every folder."""
        together = rows.hint("rebalance", DAY_OF[table])
        writer = together.write.mode("overwrite").option("partitionOverwriteMode", mode)
        writer.partitionBy(DAY_OF[table]).parquet(location)

    def replace_days(
        self, table: str, rows: DataFrame, days: Collection[dt.date | None]
    ) -> None:
        """Give some days of a table kept by day new content; the files of other
        days stay as they are. A day without rows goes. Rows of other days fail
        the job before anything is replaced.

        Days are switched one after the other once all are written. A job that
        fails in between leaves some old and some new, and is run again.
        """
        if table not in self.by_day:
            raise ValueError(f"{table} is not kept by day")
        day = DAY_OF[table]
        stray = F.assert_true(on_days(day, days), F.lit(f"a row of another {day}"))
        require(rows, WAREHOUSE_TABLES[table])
        with staged(rows.filter(stray.isNull()), "days") as given:
            location = self._location(table)
            with_rows = {row[0] for row in given.select(day).distinct().collect()}
            self._write_days(table, given, location, "dynamic")
        for gone in set(days) - with_rows:
            name = NO_VALUE if gone is None else gone.isoformat()
            drop_folder(self.spark, f"{location}/{day}={name}")
        self.spark.catalog.refreshTable(self.name(table))

    def days(self, table: str) -> list[dt.date | None]:
        """The days of a table kept by day, the latest first and None last, by
        the names of their folders; no file is opened."""
        if table not in self.by_day:
            raise ValueError(f"{table} is not kept by day")
        prefix = f"{DAY_OF[table]}="
        folders = folders_in(self.spark, self._location(table))
        names = {name.removeprefix(prefix) for name in folders if name.startswith(prefix)}
        known = sorted(map(dt.date.fromisoformat, names - {NO_VALUE}), reverse=True)
        return [*known, *([None] if NO_VALUE in names else [])]

    def rows_of_days(self, table: str, days: Collection[dt.date | None]) -> DataFrame:
        return self.table(table).filter(on_days(DAY_OF[table], days))

    def drop(self) -> None:
        """Remove the schema with its tables and files."""
        self.spark.sql(f"DROP DATABASE IF EXISTS `{self.database}` CASCADE")
        drop_folder(self.spark, self.root)

    def append(self, table: str, rows: DataFrame) -> None:
        """Add rows, also if the table already has them: two loads of the same
        rows double them. Tables that grow by loads get all of them or none."""
        if table in LOAD_OF:
            self.append_load(table, rows)
            return
        columns = ", ".join(f"`{name}`" for name in self.table(table).columns)
        self.spark.sql(
            f"INSERT INTO {self.name(table)} ({columns}) SELECT {columns} FROM {{rows}}",
            rows=rows,
        )

    def analyze(self, table: str, columns: Sequence[str]) -> None:
        """Have the catalog know the rows of a table, and of some columns the
        range, the NULLs, the distinct values and a histogram. One pass over
        them; Catalyst then tells from it which side of a join is small. Loads
        that come later do not change it, so it is done after each."""
        setting = "spark.sql.statistics.histogram.enabled"
        before = self.spark.conf.get(setting)
        self.spark.conf.set(setting, "true")
        try:
            names = ", ".join(f"`{name}`" for name in columns)
            self.spark.sql(
                f"ANALYZE TABLE {self.name(table)} COMPUTE STATISTICS FOR COLUMNS {names}"
            )
        finally:
            self.spark.conf.set(setting, before)

    def statistics(self, table: str, column: str) -> dict[str, str | None]:
        """What the catalog knows of a column, by the names Spark gives it."""
        rows = self.spark.sql(f"DESCRIBE EXTENDED {self.name(table)} `{column}`").collect()
        return {row.info_name: None if row.info_value == "NULL" else row.info_value for row in rows}

    def build_orders_fact(self, days: Collection[dt.date | None] | None = None) -> DataFrame:
        """The fact, or some days of it, from the stored dimensions."""
        orders = self.table("orders_dim") if days is None else self.rows_of_days("orders_dim", days)
        return orders_fact(orders, self.table("inventory_dim"))

    def build_courier_tracking(self, within_seconds: int | None = None) -> DataFrame:
        """The pairs within the bound; without one, all pairs of a courier."""
        gps, status = self.table("gps_dim"), self.table("status_dim")
        if within_seconds is None:
            return courier_tracking(gps, status)
        return courier_tracking_within(gps, status, within_seconds)

    def tables(self) -> DataFrame:
        """The tables of the schema with their number of rows."""
        listed = self.spark.catalog.listTables(self.database)
        names = sorted(entry.name for entry in listed if not entry.isTemporary)
        return row_counts(**{name: self.table(name) for name in names})

    def describe(self, table: str) -> DataFrame:
        # The columns come first, those that name folders behind the others.
        lines = self.spark.sql(f"DESCRIBE TABLE {self.name(table)}")
        return lines.limit(len(TABLES[table].names))
