from __future__ import annotations

import itertools
from datetime import date

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.functions.dates import label_span, month_bounds, month_label, month_runs, month_start
from tripmill.functions.types import NUMERIC_TYPES, promote, promote_types, read_type
from tripmill.spec import PipelineSpec, ServiceSpec, TableName

DTYPES = {
    "tinyint": T.ByteType(),
    "smallint": T.ShortType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
}


@pytest.mark.parametrize("a,b", list(itertools.product(NUMERIC_TYPES, repeat=2)))
def test_numeric_pairs_promote_to_the_later_type(a, b):
    assert promote({a, b}) == max(a, b, key=NUMERIC_TYPES.index)


@pytest.mark.parametrize(
    "types,expected",
    [
        (set(), "string"),
        ({"void"}, "string"),
        ({"void", "int"}, "int"),
        ({"int", "string"}, "string"),
        ({"decimal(10,2)", "int"}, "string"),
        ({"decimal(10,2)"}, "decimal(10,2)"),
        ({"timestamp", "timestamp_ntz"}, "string"),
        ({"date", "timestamp"}, "string"),
        ({"boolean", "int"}, "string"),
        ({"array<int>"}, "array<int>"),
    ],
)
def test_other_mixes(types, expected):
    assert promote(types) == expected


@pytest.mark.parametrize(
    "types,expected",
    [
        ({"int", "float"}, "double"),
        ({"bigint", "float"}, "double"),
        ({"smallint", "float"}, "float"),
        ({"int", "bigint"}, "bigint"),
        ({"bigint", "double"}, "double"),
    ],
)
def test_lossless_mode(types, expected):
    assert promote(types, lossless=True) == expected


@given(st.lists(st.sampled_from(NUMERIC_TYPES + ("void", "string", "date")), max_size=6))
def test_promotion_ignores_order_and_repetition(types):
    assert promote(types) == promote(reversed(types)) == promote(types * 2)


@given(st.sets(st.sampled_from(NUMERIC_TYPES), min_size=1))
def test_promotion_never_narrows(types):
    winner = NUMERIC_TYPES.index(promote(types))
    assert all(NUMERIC_TYPES.index(t) <= winner for t in types)


def test_promote_types_keeps_the_type_object():
    decimal = T.DecimalType(12, 3)
    assert promote_types([decimal, T.NullType()]) == decimal
    assert promote_types([T.IntegerType(), decimal]) == T.StringType()


@pytest.mark.parametrize(
    "have,want",
    [p for p in itertools.product(DTYPES, repeat=2) if promote(set(p)) == p[1]],
)
def test_every_read_type_is_readable_by_spark(spark, tmp_path, have, want):
    """The reader must accept what read_type asks for, with the right values."""
    path = str(tmp_path / "f.parquet")
    spark.range(-2, 3).select(F.col("id").cast(have).alias("X")).coalesce(1).write.parquet(path)
    ask = read_type(DTYPES[have], DTYPES[want])
    read = spark.read.schema(T.StructType([T.StructField("x", ask)])).parquet(path)
    got = [r[0] for r in read.select(F.col("x").cast(want)).collect()]
    plain = [r[0] for r in spark.read.parquet(path).select(F.col("X").cast(want)).collect()]
    assert sorted(got) == sorted(plain) and len(got) == 5


def test_month_bounds_and_runs():
    assert month_bounds(2023, 1, 5) == (date(2023, 1, 1), date(2023, 6, 1))
    assert month_bounds(2023, 12) == (date(2023, 12, 1), date(2024, 1, 1))
    assert month_runs([5, 1, 2, 2, 12]) == [(1, 2), (5, 5), (12, 12)]
    assert label_span(date(2023, 5, 1), date(2023, 6, 1)) == ("2023-05", "2023-05")
    assert label_span(date(2023, 11, 1), date(2024, 1, 1)) == ("2023-11", "2023-12")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Beirut"])
def test_month_label_ignores_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = spark.sql(
            "SELECT TIMESTAMP_NTZ'2023-03-12 02:30:00' AS gap, "
            "TIMESTAMP_NTZ'2023-01-31 23:59:59.999999' AS late"
        ).select(
            month_label(F.col("gap")),
            F.hour("gap"),
            month_label(F.col("late")),
            month_label(month_start(F.col("late"))),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert tuple(row) == ("2023-03", 2, "2023-01", "2023-01")


def test_spec_names_and_scope():
    spec = PipelineSpec("/data/landing/")
    assert spec.file_name("yellow", 3) == "yellow_tripdata_2023-03.parquet"
    assert spec.file_path("green", 1) == "/data/landing/green/green_tripdata_2023-01.parquet"
    assert spec.scope == (date(2023, 1, 1), date(2023, 6, 1))
    assert str(spec.bronze_table("yellow")) == "`spark_catalog`.`bronze`.`yellow_tripdata`"
    assert str(TableName("c", "s", "odd`name")) == "`c`.`s`.`odd``name`"


def test_gap_months_stay_unless_exact():
    loose = PipelineSpec("", months=(1, 3))
    exact = PipelineSpec("", months=(1, 3), exact_months=True)
    assert loose.scope_ranges == [(date(2023, 1, 1), date(2023, 4, 1))]
    assert exact.scope_ranges == [
        (date(2023, 1, 1), date(2023, 2, 1)),
        (date(2023, 3, 1), date(2023, 4, 1)),
    ]


@pytest.mark.parametrize(
    "changes",
    [
        {"months": ()},
        {"months": (0,)},
        {"months": (1, 1)},
        {"services": ()},
        {"on_bad_cast": "skip"},
        {"consumption_services": ("purple",)},
        {"services": (ServiceSpec("a", "p", "x", "y"), ServiceSpec("a", "q", "x", "y"))},
    ],
)
def test_bad_specs_are_refused(changes):
    with pytest.raises(ValueError):
        PipelineSpec("", **({"consumption_services": ()} | changes))


def test_service_names_must_be_plain():
    with pytest.raises(ValueError):
        ServiceSpec("a/b", "prefix", "x", "y")
