"""Grouped averages over gold: by month, by hour of day, by service, overall.

All of them filter first (plain range and threshold comparisons, which reach the Parquet
scan), aggregate partially before the shuffle, and only sort the few result rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions.dates import in_ranges, label_span, month_bounds, month_label, month_start
from tripmill.operators.gold import PICKUP_MONTH


def at_least(df: DataFrame, column: str, threshold: float | None) -> DataFrame:
    """Rows with ``column >= threshold``; NULLs fail. ``None`` keeps everything."""
    return df if threshold is None else df.filter(F.col(column) >= F.lit(threshold))


def in_month(df: DataFrame, ts_col: str, year: int, month: int) -> DataFrame:
    """Rows of one calendar month, as a half-open range.

    ``year(ts) = y AND month(ts) = m`` means the same but cannot be pushed to the scan.
    On a table in the monthly layout the partition column is filtered as well.
    """
    lo, hi = month_bounds(year, month)
    predicate = in_ranges(F.col(ts_col), [(lo, hi)])
    if PICKUP_MONTH in df.columns and ts_col != PICKUP_MONTH:
        predicate = predicate & F.col(PICKUP_MONTH).between(*map(F.lit, label_span(lo, hi)))
    return df.filter(predicate)


def _mean(column: str, digits: int, name: str) -> Column:
    return F.round(F.avg(column), digits).alias(name)


def _trips() -> Column:
    return F.count(F.lit(1)).alias("trips")


def monthly_avg(
    df: DataFrame,
    ts_col: str = "tpep_pickup_datetime",
    value_col: str = "total_amount",
    min_value: float | None = None,
    digits: int = 2,
) -> DataFrame:
    """``month, avg_<value>, trips`` per calendar month."""
    # Group by a DATE and format the few groups, rather than formatting every row.
    return (
        at_least(df, value_col, min_value)
        .groupBy(month_start(F.col(ts_col)).alias("first_day"))
        .agg(_mean(value_col, digits, f"avg_{value_col}"), _trips())
        .select(month_label(F.col("first_day")).alias("month"), f"avg_{value_col}", "trips")
        .orderBy("month")
    )


def overall_avg(
    df: DataFrame,
    value_col: str = "total_amount",
    min_value: float | None = None,
    digits: int = 2,
) -> DataFrame:
    """``avg_<value>_overall``: one row over the whole period."""
    return at_least(df, value_col, min_value).agg(
        _mean(value_col, digits, f"avg_{value_col}_overall")
    )


def hourly_avg(
    df: DataFrame,
    year: int,
    month: int,
    ts_col: str = "pickup_datetime",
    value_col: str = "passenger_count",
    min_value: float | None = None,
    digits: int = 3,
    name: str = "avg_passengers",
) -> DataFrame:
    """``hour_of_day, avg_passengers, trips`` within one month."""
    return (
        at_least(in_month(df, ts_col, year, month), value_col, min_value)
        .groupBy(F.hour(ts_col).alias("hour_of_day"))
        .agg(_mean(value_col, digits, name), _trips())
        .orderBy("hour_of_day")
    )


def service_split(
    df: DataFrame,
    year: int,
    month: int,
    ts_col: str = "pickup_datetime",
    value_col: str = "passenger_count",
    min_value: float | None = None,
    digits: int = 3,
    name: str = "avg_passengers",
) -> DataFrame:
    """``service_type, avg_passengers, trips`` within one month: who moves the mean."""
    return (
        at_least(in_month(df, ts_col, year, month), value_col, min_value)
        .groupBy("service_type")
        .agg(_mean(value_col, digits, name), _trips())
        .orderBy("service_type")
    )
