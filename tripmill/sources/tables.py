"""Catalog tables: bootstrap, full overwrite, single partitions, row accounting while writing."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripmill.spec import PipelineSpec, TableName

# Formats whose overwrite is a single commit. All others are swapped in, see ``publish``.
ATOMIC_FORMATS = ("delta", "iceberg")

#: Needed around ``insert_partitions``: only partitions that rows are written to are replaced.
DYNAMIC_PARTITIONS = {"spark.sql.sources.partitionOverwriteMode": "dynamic"}


def bootstrap(spark: SparkSession, spec: PipelineSpec, location: str | None = None) -> None:
    """Create the three layer schemas where missing and mend interrupted swaps; safe to repeat.

    ``location`` puts the managed tables of each layer in a folder of that name below it.
    """
    for schema in (spec.bronze_schema, spec.silver_schema, spec.gold_schema):
        where = f" LOCATION '{location.rstrip('/')}/{schema}'" if location else ""
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{spec.catalog}`.`{schema}`{where}")
    for table in spec.tables:
        repair(spark, table)


_PREVIOUS, _FRESH, _VERSION = "__previous_", "__fresh_", "__version_"

#: Of a view: the table that holds the rows.
_ROWS_IN = "tripmill.rows"


def repair(spark: SparkSession, table: TableName) -> None:
    """Undo what a job that died while replacing the table left behind.

    A set-aside old table takes its name back where no new one did; everything else that
    carries the table's name with a swap mark, and is not what a view shows, is dropped.
    """
    names = [r.tableName for r in spark.sql(f"SHOW TABLES IN `{table.catalog}`.`{table.schema}`").collect()]
    previous = sorted(n for n in names if n.startswith(f"{table.table}{_PREVIOUS}".lower()))
    if table.table.lower() not in names and previous:
        _rename(spark, table.renamed(previous[-1]), table)
        previous.pop()
    marked = (f"{table.table}{mark}".lower() for mark in (_FRESH, _VERSION))
    unfinished = [n for mark in marked for n in names if n.startswith(mark)]
    shown = rows_table(spark, table).table.lower() if table.table.lower() in names else None
    for name in [*previous, *unfinished]:
        if name != shown:
            spark.sql(f"DROP TABLE IF EXISTS {table.renamed(name)}")


def _rename(spark: SparkSession, old: TableName, new: TableName) -> None:
    # The new name is relative to the catalog of the renamed table.
    spark.sql(f"ALTER TABLE {old} RENAME TO `{new.schema}`.`{new.table}`")
    if spark.sql(f"DESCRIBE TABLE {new}").filter("col_name = '# Partition Information'").count():
        # Some catalogs leave the partitions of a renamed table at its old location.
        spark.sql(f"MSCK REPAIR TABLE {new} SYNC PARTITIONS")


def read_table(spark: SparkSession, table: TableName) -> DataFrame:
    return spark.table(str(table))


def row_count(spark: SparkSession, table: TableName) -> int:
    return read_table(spark, table).count()


def rows_table(spark: SparkSession, table: TableName) -> TableName:
    """The table that holds the rows: the one a view of ``publish`` shows, or the table itself."""
    if spark.catalog.getTable(str(table)).tableType != "VIEW":
        return table
    properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    if _ROWS_IN not in properties:
        raise ValueError(f"{table} is a view that was not published here")
    return table.renamed(properties[_ROWS_IN])


def new_table(table: TableName, swap: str = "rename") -> TableName:
    """A name to write the table's next rows under, which no other job uses."""
    # New names every time: leftovers of a dead job cannot block the next one.
    mark = f"{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
    return table.renamed(f"{table.table}{_VERSION if swap == 'view' else _FRESH}{mark}")


def publish(spark: SparkSession, fresh: TableName, table: TableName, swap: str = "rename") -> None:
    """Let ``table`` show the rows of the finished table ``fresh`` and drop those it showed before.

    ``"rename"``: the old table is set aside, the new one takes the name, and the old one is
    dropped. At every moment one of the two is whole, and ``repair`` finds it. Renaming a
    managed table moves its folder, which costs a copy on stores without a rename.

    ``"view"``: ``table`` is a view of the newest version. One catalog entry is replaced, schema
    included, and no file moves; a reader finds the old rows or the new ones at every moment.
    """
    exists = spark.catalog.tableExists(str(table))
    if swap != "view":
        mark = fresh.table.partition(_FRESH)[2]
        previous = table.renamed(f"{table.table}{_PREVIOUS}{mark}")
        if exists:
            _rename(spark, table, previous)
        _rename(spark, fresh, table)
        spark.sql(f"DROP TABLE IF EXISTS {previous}")
        return
    before = rows_table(spark, table) if exists else None
    if before == table:
        raise ValueError(f"{table} is a table; drop it, or replace it by renaming")
    spark.sql(
        f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ('{_ROWS_IN}' = '{fresh.table}') AS SELECT * FROM {fresh}"
    )
    if before:
        spark.sql(f"DROP TABLE IF EXISTS {before}")


def overwrite_table(
    df: DataFrame,
    table: TableName,
    table_format: str = "parquet",
    partition_by: Sequence[str] = (),
    swap: str = "rename",
) -> None:
    """Replace the table, rows and schema, with ``df``.

    Plain file formats drop the old files before the first new row is written, so a job
    that dies would leave no table. They are written to a new table first, which then
    takes the old one's place (``publish``).
    """
    spark = df.sparkSession
    if table_format in ATOMIC_FORMATS:
        writer = df.write.format(table_format).mode("overwrite").option("overwriteSchema", "true")
        (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(str(table))
        return
    fresh = new_table(table, swap)
    writer = df.write.format(table_format)
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(str(fresh))
    publish(spark, fresh, table, swap)


def _observed(df: DataFrame, metrics: Mapping[str, Column] | None) -> tuple[DataFrame, Observation]:
    seen = Observation()
    wanted = metrics or {"rows": F.count(F.lit(1))}
    return df.observe(seen, *[column.alias(name) for name, column in wanted.items()]), seen


def _counts(seen: Observation) -> dict[str, int]:
    return {name: int(value or 0) for name, value in seen.get.items()}


def overwrite_counted(
    df: DataFrame,
    table: TableName,
    metrics: Mapping[str, Column] | None = None,
    drop: Sequence[str] = (),
    table_format: str = "parquet",
    partition_by: Sequence[str] = (),
    swap: str = "rename",
) -> dict[str, int]:
    """``overwrite_table`` that returns metrics of the written rows (default: their count).

    The metrics sit right under the write, in the last stage, where Spark counts every
    task once. Further down they would be counted again whenever a lost executor makes a
    map task run twice. ``drop`` names columns that exist for the metrics only.
    """
    observed, seen = _observed(df, metrics)
    overwrite_table(observed.drop(*drop), table, table_format, partition_by, swap)
    return _counts(seen)


def insert_partitions(
    df: DataFrame,
    table: TableName,
    metrics: Mapping[str, Column] | None = None,
    drop: Sequence[str] = (),
) -> dict[str, int]:
    """Replace the partitions that ``df`` has rows for; returns metrics like ``overwrite_counted``.

    Run it under ``DYNAMIC_PARTITIONS``. Every job stages its files in a folder of its own, so jobs
    that write different partitions may run side by side. Files of other partitions stay as they are.
    """
    spark = df.sparkSession
    if spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() != "dynamic":
        raise ValueError("partitions are replaced one by one only in dynamic mode")
    target = rows_table(spark, table)
    observed, seen = _observed(df, metrics)
    rows = observed.drop(*drop).select(*read_table(spark, target).columns)
    rows.write.mode("overwrite").insertInto(str(target))
    return _counts(seen)


def partition_values(spark: SparkSession, table: TableName, column: str) -> set[str]:
    """The values of one partition column that the catalog knows."""
    rows = spark.sql(f"SHOW PARTITIONS {rows_table(spark, table)}").collect()
    pairs = (part.split("=", 1) for row in rows for part in row.partition.split("/"))
    return {value for name, value in pairs if name == column}


def drop_partitions(
    spark: SparkSession, table: TableName, column: str, values: Iterable[str], within: Mapping[str, str] | None = None
) -> None:
    """Drop the partitions with these values (and those of other columns in ``within``)."""
    target = rows_table(spark, table)
    for value in sorted(set(values) & partition_values(spark, table, column)):
        wanted = {**(within or {}), column: value}
        part = ", ".join(f"`{name}` = '{own}'" for name, own in wanted.items())
        spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION ({part})")
