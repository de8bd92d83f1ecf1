"""The layered build: landing gate, bronze, silver, gold."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.operators.gold import (
    PICKUP_MONTH,
    gold_consumption,
    gold_trips,
    trips_columns,
    with_pickup_month,
)
from tripmill.operators.silver import (
    COPIES,
    SERVICE_TYPE,
    SilverAudit,
    arrival_metrics,
    rejected_rows,
    silver_counted,
)
from tripmill.sources.drifted import SOURCE_FILE, SourceFile, scan_conformed
from tripmill.sources.landing import require_landing
from tripmill.sources.session import in_parallel, monthly_settings, sized_settings, sql_conf
from tripmill.sources.tables import (
    DYNAMIC_PARTITIONS,
    bootstrap,
    insert_partitions,
    new_table,
    overwrite_counted,
    publish,
    read_table,
)
from tripmill.spec import PipelineSpec, TableName

INGESTED_AT = "_ingested_at"
LANDED_MONTH = "landed_month"


class RowsLostError(RuntimeError):
    """Bronze does not hold the rows that the footers of the landed files promise."""

    def __init__(self, service: str, landed: int, read: int) -> None:
        super().__init__(f"{service}: {landed} rows landed, {read} rows in bronze")


@dataclass(frozen=True)
class RunReport:
    """What a run wrote: row counts per table and the silver accounting per service."""

    rows: dict[TableName, int]
    audits: dict[str, SilverAudit]


def source_files(spec: PipelineSpec, service: str) -> list[SourceFile]:
    return [SourceFile(spec.file_path(service, period)) for period in spec.periods]


def bronze(
    spark: SparkSession, spec: PipelineSpec, service: str, footers: str = "auto"
) -> DataFrame:
    """All landed rows of a service under one schema, with their file and ingest time."""
    scanned = scan_conformed(spark, source_files(spec, service), spec.lossless, footers)
    return ingested(scanned, spec)


def ingested(scanned: DataFrame, spec: PipelineSpec) -> DataFrame:
    """Rows of landed files with their ingest time, and the month of their file where bronze is
    partitioned by it (a file's name ends in ``yyyy-MM.parquet``).
    """
    stamped = scanned.withColumn(INGESTED_AT, F.current_timestamp())
    if spec.refreshable:
        stamped = stamped.withColumn(LANDED_MONTH, F.substring(SOURCE_FILE, -15, 7))
    return stamped


def write_bronze(
    spark: SparkSession, spec: PipelineSpec, service: str, footers: str = "auto"
) -> dict[str, int]:
    """Write the bronze table; returns the counts of ``arrival_metrics``."""
    rows = bronze(spark, spec, service, footers)
    return overwrite_counted(
        rows,
        spec.bronze_table(service),
        arrival_metrics(rows, spec, service),
        table_format=spec.table_format,
        partition_by=(LANDED_MONTH,) if spec.refreshable else (),
        swap=spec.swap,
    )


def write_silver(
    spark: SparkSession, spec: PipelineSpec, service: str, came_in: dict[str, int]
) -> SilverAudit:
    """Write the silver table from the bronze table in one pass and account for every row.

    Both counts come from the rows written: how many, and how many copies they stand for.
    """
    counts = overwrite_counted(
        silver_rows(spark, spec, service),
        spec.silver_table(service),
        {"kept": F.count(F.lit(1)), "in_scope": F.sum(COPIES)},
        drop=[COPIES],
        table_format=spec.table_format,
        partition_by=_partitioning(spec),
        swap=spec.swap,
    )
    return SilverAudit(
        service=service,
        raw=came_in["rows"],
        null_pickup=came_in["rows"] - came_in["pickups"] - came_in["rejected"],
        in_scope=counts["in_scope"],
        kept=counts["kept"],
        rejected=came_in["rejected"],
    )


def write_rejected(spark: SparkSession, spec: PipelineSpec, service: str) -> int:
    """Write the rows silver did not take, with their file and the reason; returns their number."""
    keep = [SOURCE_FILE, LANDED_MONTH] if spec.refreshable else [SOURCE_FILE]
    rows = rejected_rows(read_table(spark, spec.bronze_table(service)), spec, service, keep)
    if spec.refreshable:
        rows = rows.select(*[c for c in rows.columns if c != LANDED_MONTH], LANDED_MONTH)
    counts = overwrite_counted(
        rows,
        spec.rejected_table(service),
        table_format=spec.table_format,
        partition_by=(LANDED_MONTH,) if spec.refreshable else (),
        swap=spec.swap,
    )
    return counts["rows"]


def silver_rows(spark: SparkSession, spec: PipelineSpec, service: str) -> DataFrame:
    """What silver holds of the spec's scope, from the bronze table, with ``copies``."""
    rows = silver_counted(read_table(spark, spec.bronze_table(service)), spec, service)
    if spec.by_month:
        rows = with_pickup_month(rows)
    # Sorted inside each task only: a month is then a few pages of each file, which the
    # Parquet reader can skip to, and neighbouring times compress better.
    return rows.sortWithinPartitions("pickup_datetime")


def _partitioning(spec: PipelineSpec) -> Sequence[str]:
    """Gold is partitioned like silver, whose files hold one month each in the monthly
    layout, so it needs no shuffle of its own."""
    return (PICKUP_MONTH,) if spec.by_month else ()


def write_consumption(spark: SparkSession, spec: PipelineSpec, service: str) -> int:
    source = read_table(spark, spec.silver_table(service))
    counts = overwrite_counted(
        gold_consumption(source, spec, service, extra=_partitioning(spec)),
        spec.consumption_table(service),
        table_format=spec.table_format,
        partition_by=_partitioning(spec),
        swap=spec.swap,
    )
    return counts["rows"]


def write_trips(spark: SparkSession, spec: PipelineSpec) -> int:
    sources = [read_table(spark, spec.silver_table(s.name)) for s in spec.services]
    counts = overwrite_counted(
        gold_trips(sources, extra=_partitioning(spec)),
        spec.trips_table,
        table_format=spec.table_format,
        partition_by=_partitioning(spec),
        swap=spec.swap,
    )
    return counts["rows"]


def stage_trips(spark: SparkSession, spec: PipelineSpec) -> TableName:
    """An empty unified table, by service and month, that each service adds its part to."""
    empty = spark.createDataFrame([], trips_columns(extra=(PICKUP_MONTH,)))
    fresh = new_table(spec.trips_table, spec.swap)
    writer = empty.write.format(spec.table_format).partitionBy(SERVICE_TYPE, PICKUP_MONTH)
    writer.saveAsTable(str(fresh))
    return fresh


def add_trips(spark: SparkSession, spec: PipelineSpec, service: str, target: TableName) -> int:
    """Write the partitions of one service; those of others may be written at the same time."""
    source = read_table(spark, spec.silver_table(service))
    return insert_partitions(gold_trips([source], extra=(PICKUP_MONTH,)), target)["rows"]


def run(
    spark: SparkSession,
    spec: PipelineSpec,
    location: str | None = None,
    check_footers: bool = False,
    footers: str = "auto",
) -> RunReport:
    """Rebuild every layer from the landing folder. Repeating it gives the same tables.

    With ``check_footers`` the rows of bronze are held against those of the footers.
    Layers talk through tables only, so a lost executor never recomputes past the
    previous layer.
    """
    bootstrap(spark, spec, location)
    landed = require_landing(spark, spec, check_footers)

    def build(service: str) -> tuple[dict[str, int], SilverAudit]:
        came_in = write_bronze(spark, spec, service, footers)
        if landed.rows and landed.rows[service] != came_in["rows"]:
            raise RowsLostError(service, landed.rows[service], came_in["rows"])
        if spec.on_bad_cast == "route":
            write_rejected(spark, spec, service)
        audit = write_silver(spark, spec, service, came_in)
        if staged:  # this part of gold need not wait for other services
            add_trips(spark, spec, service, staged)
        return came_in, audit

    names = [s.name for s in spec.services]
    rows: dict[TableName, int] = {}
    audits: dict[str, SilverAudit] = {}
    settings = sized_settings(spark, landed.bytes)
    if spec.by_month:
        settings |= monthly_settings(len(spec.periods))
    if spec.by_service:
        settings |= DYNAMIC_PARTITIONS
    with sql_conf(spark, settings):
        staged = stage_trips(spark, spec) if spec.by_service else None
        built = in_parallel(spark, [lambda n=n: build(n) for n in names])
        for name, (came_in, audit) in zip(names, built):
            rows[spec.bronze_table(name)] = came_in["rows"]
            rows[spec.silver_table(name)] = audit.kept
            audits[name] = audit
            if spec.on_bad_cast == "route":
                rows[spec.rejected_table(name)] = audit.rejected
        gold = {
            spec.consumption_table(n): (lambda n=n: write_consumption(spark, spec, n))
            for n in spec.consumption_services
        }
        if not staged:
            gold[spec.trips_table] = lambda: write_trips(spark, spec)
        rows.update(zip(gold, in_parallel(spark, list(gold.values()))))
        if staged:
            publish(spark, staged, spec.trips_table, spec.swap)
            rows[spec.trips_table] = sum(audit.kept for audit in audits.values())
    return RunReport(rows, audits)
