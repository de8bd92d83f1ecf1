"""Gold: the tables people query, with their promised names, casing and order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions.dates import month_label
from tripmill.operators.conform import union_all
from tripmill.operators.silver import SERVICE_TYPE, TRIP_COLUMNS
from tripmill.spec import PipelineSpec

PICKUP_MONTH = "pickup_month"

# Columns of the two published tables in their order; the service's own
# time columns follow those of the consumption table.
VENDOR = "VendorID"
CONSUMPTION_COLUMNS = (VENDOR, "passenger_count", "total_amount")
TRIPS_COLUMNS = (
    "service_type",
    VENDOR,
    "passenger_count",
    "pickup_datetime",
    "dropoff_datetime",
    "total_amount",
)


def gold_consumption(
    silver: DataFrame, spec: PipelineSpec, service: str, extra: Sequence[str] = ()
) -> DataFrame:
    """One service under its original column names (and ``extra`` silver columns last)."""
    described = spec.service(service)
    return silver.select(
        *_published(CONSUMPTION_COLUMNS),
        F.col("pickup_datetime").alias(described.pickup_col),
        F.col("dropoff_datetime").alias(described.dropoff_col),
        *extra,
    )


def gold_trips(silvers: Sequence[DataFrame], extra: Sequence[str] = ()) -> DataFrame:
    """All services together (and ``extra`` silver columns last)."""
    return union_all(silvers).select(*_published(TRIPS_COLUMNS), *extra)


def trips_columns(extra: Sequence[str] = ()) -> str:
    """The schema of ``gold_trips``, as DDL."""
    types = TRIP_COLUMNS | {SERVICE_TYPE: "string", PICKUP_MONTH: "string"}
    return ", ".join(f"{name} {types[name.lower()]}" for name in (*TRIPS_COLUMNS, *extra))


def _published(names: Sequence[str]) -> list[Column]:
    return [F.col(name.lower()).alias(name) for name in names]


def with_pickup_month(silver: DataFrame) -> DataFrame:
    """Add the partition column of the monthly layout (``yyyy-MM``) at the end."""
    return silver.withColumn(PICKUP_MONTH, month_label(F.col("pickup_datetime")))
