"""Single months taken in anew, without a rebuild of the rest."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.functions.dates import in_ranges, month_day, month_label, month_number
from tripmill.operators.gold import PICKUP_MONTH, gold_consumption, gold_trips
from tripmill.operators.silver import COPIES, SERVICE_TYPE, rejected_rows, typed_trips
from tripmill.plans.medallion import LANDED_MONTH, ingested, silver_rows, source_files
from tripmill.sources.drifted import SOURCE_FILE, scan_conformed
from tripmill.sources.landing import require_landing
from tripmill.sources.session import in_parallel, monthly_settings, sized_settings, sql_conf
from tripmill.sources.tables import (
    DYNAMIC_PARTITIONS,
    bootstrap,
    drop_partitions,
    insert_partitions,
    partition_values,
    read_table,
    rows_table,
)
from tripmill.spec import Month, PipelineSpec, TableName

#: Of a silver table: months whose bronze rows changed and that are not rewritten yet.
_STALE = "tripmill.stale_months"


@dataclass(frozen=True)
class MonthAudit:
    """One pickup month of one service: bronze rows in it, and distinct ones."""

    in_scope: int
    kept: int

    @property
    def duplicates(self) -> int:
        return self.in_scope - self.kept


@dataclass(frozen=True)
class RefreshReport:
    """Rows taken in per landed month, and every pickup month that was rewritten, by service."""

    landed: dict[str, dict[str, int]]
    months: dict[str, dict[str, MonthAudit]]


def refresh(
    spark: SparkSession,
    spec: PipelineSpec,
    months: Sequence[Month],
    location: str | None = None,
    check_footers: bool = False,
    footers: str = "auto",
) -> RefreshReport:
    """Take in the files of ``months``, new or delivered again; the tables equal a full build then.

    Needs the ``refreshable`` layout. In bronze the partitions of these files are replaced. In
    silver and gold those pickup months are rewritten, from all of bronze, that hold rows the
    files had or have now, or that the scope has gained; as a row's pickup time is part of
    what makes it a duplicate, each month can be deduplicated on its own. Partitions of other
    months keep their files. Files that do not fit the bronze schema raise
    ``SchemaGrewError`` before anything is written, and a scope that has lost months is refused: both
    take a full build.

    Months that await rewriting are noted at the silver table before bronze changes, so a
    refresh that died is completed by the next one, whatever months that one names.
    """
    if not spec.refreshable:
        raise ValueError("refresh needs a spec with refreshable=True")
    named = sorted({spec.period(month) for month in months})
    unknown = sorted(set(named) - set(spec.periods))
    if not named or unknown:
        raise ValueError(f"name months of the spec: {unknown or list(months)}")
    bootstrap(spark, spec, location)
    part = replace(spec, calendar=tuple(named))
    landed = require_landing(spark, part, check_footers)
    labels = [_label(month_number(*period)) for period in named]
    names = [s.name for s in spec.services]
    in_scope = {label for lo, hi in spec.scope_ranges for label in _labels(lo, hi)}
    for name in names:
        outside = partition_values(spark, spec.silver_table(name), PICKUP_MONTH) - in_scope
        if outside:
            raise ValueError(f"{name} holds months outside the scope, build in full: {sorted(outside)}")
    read = {name: _landed_rows(spark, spec, part, name, footers) for name in names}

    def take_in(service: str) -> tuple[dict[str, int], set[str]]:
        before = partition_values(spark, spec.silver_table(service), PICKUP_MONTH)
        stale = _stale(spark, spec, service) | (in_scope - before) | _touched(spark, spec, service, labels)
        _note(spark, spec, service, stale)
        if spec.on_bad_cast == "route":
            _reject(read[service], spec, service, labels)
        counts = insert_partitions(
            read[service],
            spec.bronze_table(service),
            {f"n{i}": F.count_if(F.col(LANDED_MONTH) == label) for i, label in enumerate(labels)},
        )
        rows = {label: counts[f"n{i}"] for i, label in enumerate(labels)}
        drop_partitions(spark, spec.bronze_table(service), LANDED_MONTH, [x for x, n in rows.items() if not n])
        stale |= _touched(spark, spec, service, labels)
        _note(spark, spec, service, stale)
        return rows, stale

    def rewrite(service: str, stale: set[str]) -> dict[str, MonthAudit]:
        order = sorted(stale)
        months = replace(spec, calendar=tuple(_period(label) for label in order), exact_months=True)
        metrics = {}
        for i, label in enumerate(order):
            own = F.col(PICKUP_MONTH) == label
            metrics |= {f"kept{i}": F.count_if(own), f"in{i}": F.sum(F.when(own, F.col(COPIES)))}
        table = spec.silver_table(service)
        counts = insert_partitions(silver_rows(spark, months, service), table, metrics, drop=[COPIES])
        found = {x: MonthAudit(counts[f"in{i}"], counts[f"kept{i}"]) for i, x in enumerate(order)}
        drop_partitions(spark, table, PICKUP_MONTH, [x for x, audit in found.items() if not audit.kept])
        return found

    def consumption(service: str, stale: set[str]) -> None:
        rows = gold_consumption(_months(spark, spec, service, stale), spec, service, extra=(PICKUP_MONTH,))
        _replace(rows, spec.consumption_table(service), stale)

    def trips(services: Sequence[str], stale: set[str]) -> None:
        sources = [_months(spark, spec, name, stale) for name in services]
        within = {SERVICE_TYPE: services[0]} if spec.by_service else None
        _replace(gold_trips(sources, extra=(PICKUP_MONTH,)), spec.trips_table, stale, within)

    settings = sized_settings(spark, landed.bytes) | monthly_settings(len(spec.periods)) | DYNAMIC_PARTITIONS
    with sql_conf(spark, settings):
        taken = dict(zip(names, in_parallel(spark, [lambda n=n: take_in(n) for n in names])))
        changed = {n: stale for n, (_, stale) in taken.items() if stale}
        jobs = [lambda n=n: rewrite(n, changed[n]) for n in changed]
        audits = dict(zip(changed, in_parallel(spark, jobs)))
        gold = [lambda n=n: consumption(n, changed[n]) for n in spec.consumption_services if n in changed]
        if spec.by_service:
            gold += [lambda n=n: trips([n], changed[n]) for n in changed]
        elif changed:  # a month of all services is one partition
            gold.append(lambda: trips(names, set().union(*changed.values())))
        in_parallel(spark, gold)
    for name in names:
        _note(spark, spec, name, set())
    return RefreshReport({n: rows for n, (rows, _) in taken.items()}, {n: audits.get(n, {}) for n in names})


def _landed_rows(
    spark: SparkSession, spec: PipelineSpec, part: PipelineSpec, service: str, footers: str
) -> DataFrame:
    """The rows of the named files under the schema that bronze has."""
    stored = read_table(spark, spec.bronze_table(service)).schema
    raw = T.StructType([T.StructField(f.name, f.dataType) for f in stored if f.name not in ("_ingested_at", LANDED_MONTH)])
    return ingested(scan_conformed(spark, source_files(part, service), spec.lossless, footers, onto=raw), spec)


def _reject(landed: DataFrame, spec: PipelineSpec, service: str, labels: Sequence[str]) -> None:
    """Take the landed rows that do not fit; those of other landed months stay as they are."""
    table = spec.rejected_table(service)
    metrics = {f"n{i}": F.count_if(F.col(LANDED_MONTH) == label) for i, label in enumerate(labels)}
    rows = rejected_rows(landed, spec, service, [SOURCE_FILE, LANDED_MONTH])
    counts = insert_partitions(rows, table, metrics)
    empty = [label for i, label in enumerate(labels) if not counts[f"n{i}"]]
    drop_partitions(landed.sparkSession, table, LANDED_MONTH, empty)


def _touched(spark: SparkSession, spec: PipelineSpec, service: str, labels: Sequence[str]) -> set[str]:
    """Pickup months, inside the scope, of the bronze rows of these landed months."""
    bronze = read_table(spark, spec.bronze_table(service)).filter(F.col(LANDED_MONTH).isin(list(labels)))
    pickup = typed_trips(bronze, spec, service).select("pickup_datetime")
    rows = pickup.filter(in_ranges(F.col("pickup_datetime"), spec.scope_ranges))
    return {r.month for r in rows.select(month_label(F.col("pickup_datetime")).alias("month")).distinct().collect()}


def _months(spark: SparkSession, spec: PipelineSpec, service: str, labels: set[str]) -> DataFrame:
    silver = read_table(spark, spec.silver_table(service))
    return silver.filter(F.col(PICKUP_MONTH).isin(sorted(labels)))


def _replace(rows: DataFrame, table: TableName, labels: set[str], within: dict[str, str] | None = None) -> None:
    order = sorted(labels)
    metrics = {f"n{i}": F.count_if(F.col(PICKUP_MONTH) == label) for i, label in enumerate(order)}
    counts = insert_partitions(rows, table, metrics)
    empty = [label for i, label in enumerate(order) if not counts[f"n{i}"]]
    drop_partitions(rows.sparkSession, table, PICKUP_MONTH, empty, within)


def _stale(spark: SparkSession, spec: PipelineSpec, service: str) -> set[str]:
    table = rows_table(spark, spec.silver_table(service))
    found = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return set(filter(None, found.get(_STALE, "").split(",")))


def _note(spark: SparkSession, spec: PipelineSpec, service: str, months: Iterable[str]) -> None:
    table = rows_table(spark, spec.silver_table(service))
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_STALE}' = '{','.join(sorted(months))}')")


def _label(number: int) -> str:
    return month_day(number).strftime("%Y-%m")


def _labels(lo: date, hi: date) -> list[str]:
    return [_label(n) for n in range(month_number(lo.year, lo.month), month_number(hi.year, hi.month))]


def _period(label: str) -> tuple[int, int]:
    year, month = label.split("-")
    return int(year), int(month)
