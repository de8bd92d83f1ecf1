"""The answers people read from the gold tables, as DataFrames and as SQL text.

Thresholds come from the spec, so changing them there changes every answer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmill.functions.dates import month_bounds
from tripmill.operators.analyses import hourly_avg, monthly_avg, overall_avg, service_split
from tripmill.operators.profile import (
    amount_profile,
    layer_sizes,
    passenger_profile,
    rows_per_key,
    trip_profile,
)
from tripmill.sources.drifted import SOURCE_FILE
from tripmill.sources.tables import read_table
from tripmill.spec import Month, PipelineSpec


def monthly_amounts(spark: SparkSession, spec: PipelineSpec, service: str) -> DataFrame:
    """Average amount and trips per month of one service."""
    return monthly_avg(
        read_table(spark, spec.consumption_table(service)),
        ts_col=spec.service(service).pickup_col,
        min_value=spec.min_total_amount,
    )


def overall_amount(spark: SparkSession, spec: PipelineSpec, service: str) -> DataFrame:
    """Average amount of one service over the whole scope."""
    return overall_avg(
        read_table(spark, spec.consumption_table(service)), min_value=spec.min_total_amount
    )


def hourly_passengers(spark: SparkSession, spec: PipelineSpec, month: Month) -> DataFrame:
    """Average passengers and trips per hour of day in one month, all services."""
    return hourly_avg(
        read_table(spark, spec.trips_table), *spec.period(month), min_value=spec.min_passenger_count
    )


def passengers_by_service(spark: SparkSession, spec: PipelineSpec, month: Month) -> DataFrame:
    """What each service contributes to ``hourly_passengers``."""
    return service_split(
        read_table(spark, spec.trips_table), *spec.period(month), min_value=spec.min_passenger_count
    )


def all_layer_sizes(spark: SparkSession, spec: PipelineSpec) -> DataFrame:
    """``tbl, rows`` of every bronze and silver table and of the unified gold table."""
    layers = {}
    for service in spec.services:
        layers[f"bronze.{service.name}"] = str(spec.bronze_table(service.name))
        layers[f"silver.{service.name}"] = str(spec.silver_table(service.name))
    layers["gold.taxi_trips"] = str(spec.trips_table)
    return layer_sizes(spark, layers)


def checks(spark: SparkSession, spec: PipelineSpec, month: Month) -> dict[str, DataFrame]:
    """Every sanity check on the stored layers, by name; each is a small result."""
    found = {
        "layer_sizes": all_layer_sizes(spark, spec),
        "service_rows": rows_per_key(read_table(spark, spec.trips_table), "service_type"),
        "passengers": passenger_profile(read_table(spark, spec.trips_table), *spec.period(month)),
    }
    for service in spec.services:
        bronze = read_table(spark, spec.bronze_table(service.name))
        silver = read_table(spark, spec.silver_table(service.name))
        found[f"source_files.{service.name}"] = rows_per_key(bronze, SOURCE_FILE)
        found[f"trips.{service.name}"] = trip_profile(silver)
    for name in spec.consumption_services:
        found[f"amounts.{name}"] = amount_profile(read_table(spark, spec.consumption_table(name)))
    return found


def monthly_avg_sql(spec: PipelineSpec, service: str) -> str:
    """``monthly_amounts`` as SQL text."""
    ts_col = f"`{spec.service(service).pickup_col}`"
    return f"""
        SELECT date_format(first_day, 'yyyy-MM') AS month, avg_total_amount, trips
        FROM (
            SELECT trunc(to_date({ts_col}), 'month') AS first_day,
                   round(avg(total_amount), 2)       AS avg_total_amount,
                   count(*)                          AS trips
            FROM {spec.consumption_table(service)}
            WHERE total_amount >= {spec.min_total_amount!r}
            GROUP BY trunc(to_date({ts_col}), 'month')
        )
        ORDER BY month
    """


def overall_avg_sql(spec: PipelineSpec, service: str) -> str:
    """``overall_amount`` as SQL text."""
    return f"""
        SELECT round(avg(total_amount), 2) AS avg_total_amount_overall
        FROM {spec.consumption_table(service)}
        WHERE total_amount >= {spec.min_total_amount!r}
    """


def hourly_avg_sql(spec: PipelineSpec, month: Month) -> str:
    """``hourly_passengers`` as SQL text."""
    ts_col = "pickup_datetime"
    lo, hi = month_bounds(*spec.period(month))
    return f"""
        SELECT hour({ts_col})                 AS hour_of_day,
               round(avg(passenger_count), 3) AS avg_passengers,
               count(*)                       AS trips
        FROM {spec.trips_table}
        WHERE {ts_col} >= DATE '{lo}' AND {ts_col} < DATE '{hi}'
          AND passenger_count >= {spec.min_passenger_count}
        GROUP BY hour({ts_col})
        ORDER BY hour_of_day
    """
