from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from helpers import bronze_rows, multiset, plan, spec_for, trip
from tripmill import file_audit, rejected_rows, silver, silver_audit
from tripmill.operators.silver import SILVER_COLUMNS, distinct_rows, silver_counted

SPEC = spec_for()
KEPT = "2023-02-03 04:05:06"


def audit(spark, rows, spec=SPEC):
    return silver_audit(bronze_rows(spark, rows), spec, "yellow").first()


def test_contract(spark):
    result = silver(bronze_rows(spark, [trip(KEPT)]), SPEC, "yellow")
    assert result.dtypes == [
        ("service_type", "string"),
        ("vendorid", "int"),
        ("passenger_count", "int"),
        ("pickup_datetime", "timestamp_ntz"),
        ("dropoff_datetime", "timestamp_ntz"),
        ("total_amount", "double"),
    ]
    assert tuple(result.columns) == SILVER_COLUMNS
    assert result.first().service_type == "yellow"


def test_green_uses_its_own_time_columns(spark):
    green = bronze_rows(spark, [trip(KEPT)]).withColumnsRenamed(
        {
            "tpep_pickup_datetime": "lpep_pickup_datetime",
            "tpep_dropoff_datetime": "lpep_dropoff_datetime",
        }
    )
    row = silver(green, SPEC, "green").first()
    assert str(row.pickup_datetime) == KEPT and row.service_type == "green"


@pytest.mark.parametrize(
    "pickup,kept",
    [
        ("2023-01-01 00:00:00", True),
        ("2022-12-31 23:59:59.999999", False),
        ("2023-05-31 23:59:59.999999", True),
        ("2023-06-01 00:00:00", False),
        (None, False),
    ],
)
def test_scope_edges(spark, pickup, kept):
    assert silver(bronze_rows(spark, [trip(pickup)]), SPEC, "yellow").count() == kept


@pytest.mark.parametrize(
    "pickup,kept",
    [
        ("2023-12-01 00:00:00", True),
        ("2023-12-31 23:59:59.999999", True),
        ("2024-01-01 00:00:00", False),
    ],
)
def test_december_scope(spark, pickup, kept):
    spec = spec_for(months=(12,))
    assert silver(bronze_rows(spark, [trip(pickup)]), spec, "yellow").count() == kept


def test_gap_months(spark):
    rows = bronze_rows(spark, [trip(f"2023-0{m}-10 00:00:00") for m in (1, 2, 3)])
    assert silver(rows, spec_for(months=(1, 3)), "yellow").count() == 3
    assert silver(rows, spec_for(months=(1, 3), exact_months=True), "yellow").count() == 2


def test_duplicates_on_kept_columns_collapse(spark):
    rows = [
        trip(KEPT),
        trip(KEPT),
        trip(KEPT, passengers=None),
        trip(KEPT, passengers=None),
        trip(KEPT, amount=float("nan")),
        trip(KEPT, amount=float("nan")),
        trip(KEPT, amount=0.0),
        trip(KEPT, amount=-0.0),
        trip(KEPT, dropoff="2023-02-03 05:00:00"),
    ]
    extra = bronze_rows(spark, rows).withColumn("tip", F.monotonically_increasing_id())
    assert silver(extra, SPEC, "yellow").count() == 5


def test_distinct_rows_has_nothing_left_to_collapse(spark):
    once = distinct_rows(bronze_rows(spark, [trip(KEPT)] * 50 + [trip(KEPT, vendor=2)]))
    assert once.count() == 2 and distinct_rows(once).count() == 2


def test_counts_stand_for_all_copies(spark):
    rows = [trip(KEPT)] * 3 + [trip(KEPT, vendor=2)]
    counted = silver_counted(bronze_rows(spark, rows), SPEC, "yellow").collect()
    assert sorted((r.vendorid, r.copies) for r in counted) == [(1, 3), (2, 1)]


def test_casts_truncate_toward_zero(spark):
    rows = [trip(KEPT, passengers=p) for p in (1.5, -1.5)]
    got = silver(bronze_rows(spark, rows), SPEC, "yellow").collect()
    assert sorted(r.passenger_count for r in got) == [-1, 1]


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.mark.parametrize("bad", [float("nan"), 3e10])
def test_values_that_do_not_fit(spark, ansi, bad):
    rows = bronze_rows(spark, [trip(KEPT, passengers=bad), trip(KEPT, vendor=7)])
    with pytest.raises(PySparkException):
        silver(rows, SPEC, "yellow").collect()
    kept = silver(rows, spec_for(on_bad_cast="null"), "yellow").collect()
    assert sorted((r.vendorid, r.passenger_count) for r in kept) == [(1, None), (7, 1)]


def test_text_that_is_no_number(spark, ansi):
    rows = bronze_rows(spark, [trip(KEPT)]).withColumn("vendorid", F.lit("abc"))
    with pytest.raises(PySparkException):
        silver(rows, SPEC, "yellow").collect()
    assert silver(rows, spec_for(on_bad_cast="null"), "yellow").first().vendorid is None


def test_rows_that_do_not_fit_are_routed(spark, ansi):
    spec = spec_for(on_bad_cast="route")
    bad = trip(KEPT, passengers=3e10)
    rows = bronze_rows(spark, [bad, bad, trip(KEPT, vendor=7), trip(None), trip("1990-01-01 00:00:00")])
    rows = rows.withColumn("vendorid", F.when(F.col("vendorid") == 7, "x").otherwise(F.col("vendorid").cast("string")))
    rows = rows.unionByName(bronze_rows(spark, [trip(KEPT), trip(KEPT)]).withColumn("vendorid", F.lit("1")))
    assert [(r.vendorid, r.passenger_count) for r in silver(rows, spec, "yellow").collect()] == [(1, 1)]
    found = rejected_rows(rows, spec, "yellow").collect()
    assert sorted((r.vendorid, r.passenger_count, r.reason) for r in found) == [
        ("1", "3.0E10", "passenger_count does not fit int"),
        ("1", "3.0E10", "passenger_count does not fit int"),
        ("x", "1.0", "vendorid does not fit int"),
    ]
    assert found[0].pickup_datetime == KEPT and found[0].service_type == "yellow"
    audit = silver_audit(rows, spec, "yellow").first().asDict()
    assert audit == {
        "service_type": "yellow", "raw": 7, "null_pickup": 1, "in_scope": 2, "kept": 1, "rejected": 3,
        "out_of_scope": 2, "duplicates": 1,
    }


def test_a_pickup_that_is_no_time_is_rejected_not_missing(spark, ansi):
    spec = spec_for(on_bad_cast="route")
    rows = bronze_rows(spark, [trip(KEPT), trip(None)]).withColumn(
        "tpep_pickup_datetime", F.coalesce(F.col("tpep_pickup_datetime").cast("string"), F.lit("soon"))
    )
    audit = silver_audit(rows, spec, "yellow").first()
    assert (audit.rejected, audit.null_pickup, audit.kept) == (1, 0, 1)
    [routed] = rejected_rows(rows, spec, "yellow").collect()
    assert (routed.pickup_datetime, routed.reason) == ("soon", "pickup_datetime does not fit timestamp_ntz")


def test_nothing_is_read_to_route_rows_of_silver_types(spark):
    typed = spark.createDataFrame([], (
        "vendorid int, passenger_count int, tpep_pickup_datetime timestamp_ntz, "
        "tpep_dropoff_datetime timestamp_ntz, total_amount double"
    ))
    routed = rejected_rows(typed.unionByName(typed), spec_for(on_bad_cast="route"), "yellow")
    assert "Union" not in plan(routed) and routed.count() == 0


def test_accounting_by_file(spark):
    files = [("y_2023-02.parquet", KEPT), ("y_2023-01.parquet", KEPT), ("y_2023-01.parquet", KEPT),
             ("y_2023-02.parquet", "1990-01-01 00:00:00"), ("y_2022-12.parquet", None), ("odd", KEPT), ("odd", None)]
    names = spark.createDataFrame([(i, n) for i, (n, _) in enumerate(files)], "vendorid long, _source_file string")
    rows = bronze_rows(spark, [trip(at, vendor=i) for i, (_, at) in enumerate(files)])
    rows = rows.join(names, "vendorid").withColumn("vendorid", F.lit(1).cast("long"))
    found = file_audit(rows, SPEC, "yellow").drop("service_type").collect()
    assert {r._source_file: tuple(r)[1:] for r in found} == {
        # raw, null_pickup, in_scope, kept, out_of_scope, duplicates
        "yellow_tripdata_2022-12.parquet": (1, 1, 0, 0, 1, 0),
        "yellow_tripdata_2023-01.parquet": (2, 0, 2, 1, 0, 1),
        "yellow_tripdata_2023-02.parquet": (2, 0, 1, 0, 1, 1),
        None: (2, 1, 1, 0, 1, 1),
    }
    assert file_audit(rows.limit(0), SPEC, "yellow").count() == 0


def test_business_filters_are_not_applied(spark):
    rows = [trip(KEPT, passengers=None), trip(KEPT, passengers=0.0), trip(KEPT, amount=-3.0)]
    assert silver(bronze_rows(spark, rows), SPEC, "yellow").count() == 3


def test_audit(spark):
    rows = [trip(KEPT)] * 3 + [trip(None), trip("2030-01-01 00:00:00"), trip(KEPT, vendor=2)]
    assert audit(spark, rows).asDict() == {
        "service_type": "yellow",
        "raw": 6,
        "null_pickup": 1,
        "in_scope": 4,
        "kept": 2,
        "out_of_scope": 2,
        "duplicates": 2,
    }


def test_audit_of_nothing(spark):
    assert list(audit(spark, []))[1:] == [0] * 6


PICKUPS = [None, "2022-12-31 23:59:59", "2023-01-01 00:00:00", KEPT, "2023-06-01 00:00:00"]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.builds(
            trip,
            st.sampled_from(PICKUPS),
            vendor=st.integers(1, 2),
            passengers=st.sampled_from([None, 0.0, 1.0, 2.0]),
            amount=st.sampled_from([-1.0, 0.0, 5.0]),
        ),
        max_size=30,
    )
)
def test_every_row_is_accounted_for(spark, rows):
    bronze = bronze_rows(spark, rows)
    counts = silver_audit(bronze, SPEC, "yellow").first()
    result = silver(bronze, SPEC, "yellow")
    assert counts.raw == len(rows) == counts.out_of_scope + counts.duplicates + counts.kept
    assert counts.kept == result.count() == result.distinct().count()
    # Silver of silver is silver.
    again = result.select(
        "vendorid",
        "passenger_count",
        F.col("pickup_datetime").alias("tpep_pickup_datetime"),
        F.col("dropoff_datetime").alias("tpep_dropoff_datetime"),
        "total_amount",
    )
    assert multiset(silver(again, SPEC, "yellow")) == multiset(result)
