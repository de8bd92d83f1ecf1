"""Data-quality profiles, counts per key, layer sizes and previews. One pass each."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.operators.analyses import in_month


# The result names of the published checks.
NO_PASSENGERS, NEGATIVE_AMOUNT = "passengers_null_or_zero", "total_amount_negative"
UNFILTERED_MEAN = "avg_unfiltered"
MONTH_ROWS, NULL_PASSENGERS, ZERO_PASSENGERS = "month_rows", "passenger_null", "passenger_zero"


def trip_profile(silver: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Date range and rows the analyses will filter out, overall or per key.

    ``count_if`` gives 0 on empty input, where a conditional sum would give NULL.
    """
    profile = silver.groupBy(*by).agg(
        F.min("pickup_datetime").alias("min_pickup"),
        F.max("pickup_datetime").alias("max_pickup"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("passenger_count").isNull() | (F.col("passenger_count") == 0)).alias(
            NO_PASSENGERS
        ),
        F.count_if(F.col("total_amount") < 0).alias(NEGATIVE_AMOUNT),
    )
    return profile.orderBy(*by) if by else profile


def amount_profile(df: DataFrame, value_col: str = "total_amount") -> DataFrame:
    """``rows, negative, zero, min, max, avg_unfiltered`` of an amount."""
    value = F.col(value_col)
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(value < 0).alias("negative"),
        F.count_if(value == 0).alias("zero"),
        F.round(F.min(value), 2).alias("min"),
        F.round(F.max(value), 2).alias("max"),
        F.round(F.avg(value), 2).alias(UNFILTERED_MEAN),
    )


def passenger_profile(
    df: DataFrame, year: int, month: int, ts_col: str = "pickup_datetime"
) -> DataFrame:
    """``month_rows, passenger_null, passenger_zero`` of one month."""
    return in_month(df, ts_col, year, month).agg(
        F.count(F.lit(1)).alias(MONTH_ROWS),
        F.count_if(F.col("passenger_count").isNull()).alias(NULL_PASSENGERS),
        F.count_if(F.col("passenger_count") == 0).alias(ZERO_PASSENGERS),
    )


def rows_per_key(df: DataFrame, key: str) -> DataFrame:
    """``key, count``: rows per source file, per service, ... in no particular order."""
    return df.groupBy(key).count()


def layer_sizes(spark: SparkSession, layers: Mapping[str, str]) -> DataFrame:
    """``tbl, rows`` for each label to (quoted) table name, as one SQL statement."""
    counts = [
        f"SELECT '{label}' AS tbl, count(*) AS rows FROM {table}"
        for label, table in layers.items()
    ]
    return spark.sql(" UNION ALL ".join(counts) + " ORDER BY tbl")


def preview(
    df: DataFrame,
    n: int,
    columns: Sequence[str] | None = None,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """``n`` rows of some columns. With ``order_by`` the same rows every time: each task
    keeps its best ``n``, there is no full sort."""
    picked = df.select(*columns) if columns else df
    return (picked.orderBy(*order_by) if order_by else picked).limit(n)
