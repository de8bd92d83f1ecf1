"""The registered queries: every operator over the shared test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.functions.dates import month_label, month_start
from tripmill.operators.analyses import hourly_avg, monthly_avg, overall_avg, service_split
from tripmill.operators.conform import conform_union, union_all
from tripmill.operators.gold import TRIPS_COLUMNS, gold_consumption, gold_trips
from tripmill.operators.profile import (
    amount_profile,
    passenger_profile,
    preview,
    rows_per_key,
    trip_profile,
)
from tripmill.operators.silver import (
    SILVER_COLUMNS,
    distinct_rows,
    file_audit,
    rejected_rows,
    silver,
    silver_audit,
)
from tripmill.plans.answers import (
    all_layer_sizes,
    hourly_avg_sql,
    monthly_avg_sql,
    overall_avg_sql,
)
from tripmill.plans.fleet import (
    built_by_service,
    built_fleet,
    deliver,
    fleet_spec,
    folder_drift,
    land_months,
    landed_fleet,
    misread,
    own_schemas,
    raw_trips,
    table,
    type_drift,
)
from tripmill.plans.medallion import run, source_files
from tripmill.plans.refresh import refresh
from tripmill.sources.drifted import drift_report, rows_per_file, scan_conformed
from tripmill.sources.landing import file_status, match_arrivals, missing_files
from tripmill.sources.session import scratch_dir
from tripmill.sources.tables import bootstrap, overwrite_table, read_table
from tripmill.spec import MIN_PASSENGER_COUNT, MIN_TOTAL_AMOUNT, PipelineSpec

Query = Callable[[SparkSession, str], DataFrame]

SERVICES = ("yellow", "green")
Q2_MONTH = (1997, 5)
GRID_START, GRID_MONTHS = "1995-01-01", 84


def _silver(spark: SparkSession, sf_dir: str, service: str) -> DataFrame:
    return silver(raw_trips(spark, sf_dir, service), fleet_spec(), service)


def _consumption(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_consumption(_silver(spark, sf_dir, "yellow"), fleet_spec(), "yellow")


def _trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_trips([_silver(spark, sf_dir, s) for s in SERVICES])


def landing_completeness(
    spark: SparkSession, sf_dir: str, start: str = GRID_START, months: int = GRID_MONTHS
) -> DataFrame:
    """Expected (service, month) grid against the months trips arrived for.

    Months that nobody expected are reported, too, if trips arrived for them.
    """
    expected = (
        spark.range(months)
        .withColumn("first_day", F.add_months(F.lit(start).cast("date"), F.col("id").cast("int")))
        .select(F.explode(F.array(*map(F.lit, SERVICES))).alias("service"), "first_day")
    )
    arrived = union_all(
        [
            raw_trips(spark, sf_dir, s)
            .groupBy(month_start(F.col(fleet_spec().service(s).pickup_col)).alias("first_day"))
            .agg(F.count(F.lit(1)).alias("found"))
            .withColumn("service", F.lit(s))
            for s in SERVICES
        ]
    )
    return (
        match_arrivals(expected, arrived, ["service", "first_day"], unexpected=True)
        .select(
            "service",
            month_label(F.col("first_day")).alias("month"),
            F.col("found").isNotNull().alias("present"),
            F.coalesce("found", F.lit(0)).alias("rows_found"),
        )
        .orderBy("service", "month")
    )


def drift_report_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift_report(spark, source_files(landed_fleet(spark, sf_dir), "yellow"))


def bronze_conformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_conformed(spark, source_files(landed_fleet(spark, sf_dir), "yellow"))


def lineage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_per_key(bronze_conformed(spark, sf_dir), "_source_file").orderBy("_source_file")


def silver_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_all([_silver(spark, sf_dir, s) for s in SERVICES])


def sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver through a managed table in fresh schemas and back."""
    spec = own_schemas(spark, fleet_spec())
    bootstrap(spark, spec, scratch_dir(spark, "tables"))
    target = spec.table(spec.silver_schema, "trips")
    overwrite_table(silver_trips(spark, sf_dir), target, spec.table_format)
    return read_table(spark, target)


def dedupe_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_rows(raw_trips(spark, sf_dir, "yellow"))


def silver_audit_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_all(
        [silver_audit(raw_trips(spark, sf_dir, s), fleet_spec(), s) for s in SERVICES]
    ).orderBy("service_type")


def silver_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trip_profile(silver_trips(spark, sf_dir), ["service_type"])


def service_row_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_per_key(_trips(spark, sf_dir), "service_type").orderBy("service_type")


def preview_mandated(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [
        "vendorid",
        "passenger_count",
        "total_amount",
        "tpep_pickup_datetime",
        "tpep_dropoff_datetime",
    ]
    return preview(raw_trips(spark, sf_dir, "yellow"), 10, columns, order_by=columns)


def layer_sizes_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The size of each layer, in SQL, after a whole build from landing files to gold."""
    return all_layer_sizes(spark, built_fleet(spark, sf_dir))


def landing_status_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed files of five months against six expected ones, with the rows of each file."""
    landed = landed_fleet(spark, sf_dir)
    rows = union_all([rows_per_file(spark, source_files(landed, s)) for s in SERVICES])
    status = file_status(spark, _one_more_month(spark, sf_dir)).drop("size_mb")
    return match_arrivals(status, rows, ["file"]).select(
        "service", "month", "file", "present", F.coalesce("rows_in_file", F.lit(0)).alias("rows_found")
    ).orderBy("service", "month")


def _one_more_month(spark: SparkSession, sf_dir: str) -> PipelineSpec:
    spec = landed_fleet(spark, sf_dir)
    return replace(spec, months=(*spec.months, max(spec.months) + 1))


def missing_files_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of six expected months did not land."""
    return missing_files(spark, _one_more_month(spark, sf_dir))


def bronze_folder_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of one logical file whose parts have different schemas."""
    return scan_conformed(spark, [folder_drift(spark, sf_dir)])


def drift_report_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drift that ends in a string, and drift between narrow types."""
    return drift_report(spark, type_drift(spark, sf_dir))


def _misfits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Green trips as text and wide numbers, of which some do not fit silver's types."""
    raw = raw_trips(spark, sf_dir, "green")
    text = F.when(F.col("total_amount") < 0, "abc").otherwise(F.col("passenger_count").cast("string"))
    wide = F.when(F.col("passenger_count") == 3, 3e10).otherwise(F.col("vendorid"))
    return raw.withColumns({"passenger_count": text, "vendorid": wide.cast("double")})


def bad_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver from text and numbers of which some do not fit; those become NULL."""
    return silver(_misfits(spark, sf_dir), replace(fleet_spec(), on_bad_cast="null"), "green")


def rejected_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows with values that do not fit, as they came, and why silver does not take them."""
    return rejected_rows(_misfits(spark, sf_dir), replace(fleet_spec(), on_bad_cast="route"), "green")


def routed_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where all rows went when those that do not fit are kept out of silver."""
    return silver_audit(_misfits(spark, sf_dir), replace(fleet_spec(), on_bad_cast="route"), "green")


def file_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the rows of each landed file went, from the bronze tables of a whole build."""
    spec = built_fleet(spark, sf_dir)
    audits = [file_audit(read_table(spark, spec.bronze_table(s)), spec, s) for s in SERVICES]
    return union_all(audits).orderBy("service_type", "_source_file")


def pipeline_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per table of a whole build from landing files, and where silver's rows went."""
    spec = own_schemas(spark, landed_fleet(spark, sf_dir, redelivered=True))
    report = run(spark, spec, scratch_dir(spark, "tables"), check_footers=True)
    layers = {spec.bronze_schema: "bronze", spec.silver_schema: "silver", spec.gold_schema: "gold"}
    found = [(f"{layers[t.schema]}.{t.table}", n) for t, n in report.rows.items()]
    for service, audit in report.audits.items():
        found.append((f"out of scope, {service}", audit.out_of_scope))
        found.append((f"duplicates, {service}", audit.duplicates))
    return spark.createDataFrame(found, "what string, rows long").orderBy("what")


def refreshed_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver after a month that was delivered wrong has been delivered again and refreshed."""
    spec = replace(fleet_spec(scratch_dir(spark, "landing")), refreshable=True, swap="view")
    spec = own_schemas(spark, spec)
    held = land_months(spark, sf_dir, spec)
    march = (spec.year, 3)
    for service in SERVICES:
        deliver(misread(held[service, march]), spec, service, march)
    tables = scratch_dir(spark, "tables")
    run(spark, spec, tables)
    for service in SERVICES:
        deliver(held[service, march], spec, service, march)
    refresh(spark, spec, [march], tables)
    return union_all([read_table(spark, spec.silver_table(s)) for s in SERVICES]).select(*SILVER_COLUMNS)


def two_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unified gold of two winters' months: a build of the first year, to which the next is added."""
    winter = ((1996, 11), (1996, 12), (1997, 1), (1997, 2))
    spec = replace(fleet_spec(scratch_dir(spark, "landing")), calendar=winter, refreshable=True, by_service=True)
    spec = own_schemas(spark, spec)
    land_months(spark, sf_dir, spec)
    tables = scratch_dir(spark, "tables")
    run(spark, replace(spec, calendar=winter[:2]), tables)
    refresh(spark, spec, winter[2:], tables)
    return read_table(spark, spec.trips_table).select(*TRIPS_COLUMNS)


def yellow_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One service in one month, from gold laid out by both."""
    trips = read_table(spark, built_by_service(spark, sf_dir).trips_table)
    return hourly_avg(trips.filter(F.col("service_type") == "yellow"), *Q2_MONTH, min_value=MIN_PASSENGER_COUNT)


def bronze_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drifted files as one frame each, conformed and unioned."""
    files = source_files(landed_fleet(spark, sf_dir), "yellow")
    return conform_union(
        [spark.read.parquet(f.path).withColumn("_source_file", F.lit(f.name)) for f in files]
    )


def q1_monthly_avg_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = built_fleet(spark, sf_dir)
    return spark.sql(monthly_avg_sql(spec, "yellow"))


def q1_overall_avg_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = built_fleet(spark, sf_dir)
    return spark.sql(overall_avg_sql(spec, "yellow"))


def q2_hourly_avg_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = built_fleet(spark, sf_dir)
    return spark.sql(hourly_avg_sql(spec, Q2_MONTH[1]))


def _events_hourly(spark: SparkSession, sf_dir: str, least: float | None) -> DataFrame:
    return hourly_avg(
        table(spark, sf_dir, "events"), 2024, 1, ts_col="ts", value_col="value", min_value=least, name="avg_value"
    )


def queries() -> dict[str, Query]:
    return {
        "landing_completeness": landing_completeness,
        "landing_status": landing_status_query,
        "drift_report": drift_report_query,
        "bronze_conformed": bronze_conformed,
        "bronze_union": bronze_union,
        "lineage_counts": lineage_counts,
        "sink_roundtrip": sink_roundtrip,
        "silver_trips": silver_trips,
        "dedupe_trips": dedupe_trips,
        "silver_audit": silver_audit_query,
        "silver_profile": silver_profile,
        "gold_consumption": _consumption,
        "gold_taxi_trips": _trips,
        "service_row_split": service_row_split,
        "preview_mandated": preview_mandated,
        "layer_sizes": layer_sizes_query,
        "quality_amount": lambda spark, d: amount_profile(_consumption(spark, d)),
        "quality_passengers": lambda spark, d: passenger_profile(_trips(spark, d), *Q2_MONTH),
        "q1_monthly_avg": lambda spark, d: monthly_avg(
            _consumption(spark, d), min_value=MIN_TOTAL_AMOUNT
        ),
        "q1_monthly_avg_sql": q1_monthly_avg_sql,
        "q1_overall_avg": lambda spark, d: overall_avg(
            _consumption(spark, d), min_value=MIN_TOTAL_AMOUNT
        ),
        "q1_overall_avg_sql": q1_overall_avg_sql,
        "q2_hourly_avg": lambda spark, d: hourly_avg(
            _trips(spark, d), *Q2_MONTH, min_value=MIN_PASSENGER_COUNT
        ),
        "q2_hourly_avg_sql": q2_hourly_avg_sql,
        "q2_service_split": lambda spark, d: service_split(
            _trips(spark, d), *Q2_MONTH, min_value=MIN_PASSENGER_COUNT
        ),
        "events_hourly": lambda spark, d: _events_hourly(spark, d, None),
        "events_hourly_above": lambda spark, d: _events_hourly(spark, d, 1.0),
        "missing_files": missing_files_query,
        "bronze_folder_drift": bronze_folder_drift,
        "drift_report_types": drift_report_types,
        "bad_casts": bad_casts,
        "rejected_trips": rejected_trips,
        "routed_audit": routed_audit,
        "file_accounts": file_accounts,
        "pipeline_run": pipeline_run,
        "refreshed_month": refreshed_month,
        "two_years": two_years,
        "yellow_hours": yellow_hours,
    }
