"""Small frames and plan readers used by several tests."""

from __future__ import annotations

import re
import uuid
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tripmill import PipelineSpec

BRONZE = (
    "vendorid bigint, passenger_count double, tpep_pickup_datetime timestamp_ntz, "
    "tpep_dropoff_datetime timestamp_ntz, total_amount double"
)


def spec_for(root="", **changes) -> PipelineSpec:
    return replace(PipelineSpec(str(root)), **changes)


def own_schemas(spec: PipelineSpec) -> PipelineSpec:
    tag = uuid.uuid4().hex[:10]
    return replace(
        spec, bronze_schema=f"b_{tag}", silver_schema=f"s_{tag}", gold_schema=f"g_{tag}"
    )


def bronze_rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, BRONZE)


def ts(text: str | None) -> datetime | None:
    return datetime.fromisoformat(text) if text else None


def trip(pickup, vendor=1, passengers=1.0, amount=10.0, dropoff="2023-01-01 01:00:00"):
    return (vendor, passengers, ts(pickup), ts(dropoff), amount)


def plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df: DataFrame) -> int:
    return len(re.findall(r"FileScan parquet", plan(df)))


def exchanges(df: DataFrame) -> list[str]:
    return re.findall(r"Exchange (\w+)", plan(df))


def pushed(df: DataFrame) -> list[str]:
    """The PushedFilters of every scan, untruncated."""
    jvm_plan = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    return re.findall(r"PushedFilters: (\[.*?\])\n", jvm_plan)


def read_schemas(df: DataFrame) -> list[str]:
    jvm_plan = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    return re.findall(r"ReadSchema: (struct<.*?>)\n", jvm_plan)


def multiset(df: DataFrame) -> list[str]:
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))
