from __future__ import annotations

import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from helpers import exchanges, plan, pushed, read_schemas, spec_for
from tripmill import gold_consumption, gold_trips, hourly_avg, monthly_avg, preview, silver
from tripmill.operators.silver import silver_counted
from tripmill.plans import fleet


def shuffled_rows(df):
    """Rows written to the first shuffle, from the metrics of the executed plan."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan().executedPlan()
    while "Exchange" not in node.nodeName():
        node = node.plan() if "QueryStage" in node.nodeName() else node.children().apply(0)
    return node.metrics().apply("shuffleRecordsWritten").value()


@pytest.fixture(scope="module")
def bronze_table(spark, tmp_path_factory):
    """A stored bronze table with more columns than silver needs."""
    path = str(tmp_path_factory.mktemp("bronze") / "t")
    spark.range(2000).select(
        (F.col("id") % 3).alias("vendorid"),
        (F.col("id") % 5).cast("double").alias("passenger_count"),
        F.expr("TIMESTAMP_NTZ'2022-12-20 00:00:00' + id * INTERVAL '2' HOUR").alias(
            "tpep_pickup_datetime"
        ),
        F.expr("TIMESTAMP_NTZ'2022-12-20 00:30:00' + id * INTERVAL '2' HOUR").alias(
            "tpep_dropoff_datetime"
        ),
        (F.col("id") % 100).cast("double").alias("total_amount"),
        F.lit("wide").alias("unused_text"),
        F.lit("file").alias("_source_file"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_silver_prunes_and_pushes_the_scope(bronze_table):
    result = silver(bronze_table, spec_for(), "yellow")
    [filters] = pushed(result)
    assert "GreaterThanOrEqual(tpep_pickup_datetime,2023-01-01T00:00)" in filters
    assert "LessThan(tpep_pickup_datetime,2023-06-01T00:00)" in filters
    [schema] = read_schemas(result)
    assert "unused_text" not in schema and "_source_file" not in schema


def test_lenient_casts_do_not_block_the_scope(bronze_table):
    [filters] = pushed(silver(bronze_table, spec_for(on_bad_cast="null"), "yellow"))
    assert "GreaterThanOrEqual(tpep_pickup_datetime,2023-01-01T00:00)" in filters


@pytest.mark.parametrize("build", [silver, silver_counted])
def test_dedupe_is_one_shuffle_with_map_side_collapse(bronze_table, build):
    result = build(bronze_table, spec_for(), "yellow")
    assert exchanges(result) == ["hashpartitioning"]
    assert plan(result).count("HashAggregate") == 2
    # The constant service tag stays out of the shuffle.
    assert "yellow" not in re.search(r"hashpartitioning\((.*?)\)", plan(result)).group(1)


def test_exact_months_are_pushed_as_ranges(bronze_table):
    spec = spec_for(months=(1, 3), exact_months=True)
    [filters] = pushed(silver(bronze_table, spec, "yellow"))
    assert filters.count("GreaterThanOrEqual(tpep_pickup_datetime") == 2 and "Or(" in filters


def test_analysis_filters_go_through_the_dedupe(bronze_table):
    gold = gold_consumption(silver(bronze_table, spec_for(), "yellow"), spec_for(), "yellow")
    [filters] = pushed(monthly_avg(gold, min_value=0.0))
    assert "GreaterThanOrEqual(total_amount,0.0)" in filters


def test_a_service_filter_removes_the_other_branches(bronze_table):
    def renamed(frame):
        return frame.withColumnsRenamed(
            {
                "tpep_pickup_datetime": "lpep_pickup_datetime",
                "tpep_dropoff_datetime": "lpep_dropoff_datetime",
            }
        )

    spec = spec_for()
    trips = gold_trips(
        [silver(bronze_table, spec, "yellow"), silver(renamed(bronze_table), spec, "green")]
    )
    assert plan(trips).count("FileScan") == 2
    assert plan(trips.filter("service_type = 'green'")).count("FileScan") == 1


def test_grouped_averages_aggregate_before_they_shuffle(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    result = hourly_avg(
        events, 2024, 1, ts_col="ts", value_col="value", min_value=1, name="avg_value"
    )
    assert "partial_avg" in plan(result)
    [filters] = pushed(result)
    assert "GreaterThanOrEqual(ts,2024-01-01T00:00)" in filters
    assert "GreaterThanOrEqual(value,1.0)" in filters
    [schema] = read_schemas(result)
    assert schema == "struct<ts:timestamp_ntz,value:double>"


def test_an_ordered_preview_does_not_sort_everything(bronze_table):
    text = plan(preview(bronze_table, 10, ["total_amount"], order_by=["total_amount"]))
    assert "TakeOrderedAndProject" in text and "Exchange" not in text


def test_no_cross_join_or_python_in_any_registered_query(spark, sf_dir):
    from tripmill.plans.registered import queries

    for name, query in queries().items():
        text = plan(query(spark, sf_dir))
        assert "NestedLoop" not in text and "CartesianProduct" not in text, name
        assert "Python" not in text and "InPandas" not in text, name


def test_a_hot_row_is_collapsed_before_the_shuffle(spark):
    """A third of all rows being the same row must not make one reducer hot."""
    rows = spark.range(0, 90_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("vendorid"),
        F.lit(1.0).alias("passenger_count"),
        F.expr("TIMESTAMP_NTZ'2023-02-02 00:00:00'").alias("tpep_pickup_datetime"),
        F.expr("TIMESTAMP_NTZ'2023-02-02 00:10:00'").alias("tpep_dropoff_datetime"),
        F.lit(5.0).alias("total_amount"),
    )
    counted = silver_counted(rows, spec_for(), "yellow")
    hot = counted.orderBy(F.desc("copies")).first()
    assert hot.copies == 30_000 and counted.count() == 60_001
    assert counted.agg(F.sum("copies")).first()[0] == 90_000
    # 16 map tasks: the hot row crosses the shuffle at most 16 times, not 30,000 times.
    assert shuffled_rows(silver_counted(rows, spec_for(), "yellow")) <= 60_000 + 16


def test_splitting_trips_sorts_no_task(spark, tmp_path, monkeypatch):
    """A task that sorts its trips by file holds all of them at once."""
    ids = F.col("id")
    frames = {
        "lineitem": spark.range(50).selectExpr(
            "id AS l_orderkey", "id % 7 AS l_suppkey", "id AS l_partkey", "id * 1.5D AS l_quantity", "1 AS l_linenumber",
            "DATE'1997-01-05' AS l_shipdate", "id * 2.0D AS l_extendedprice", "IF(id % 3 = 0, 'R', 'N') AS l_returnflag",
        ),
        "orders": spark.range(30).select(
            ids.alias("o_orderkey"), ids.alias("o_custkey"), F.lit("1997-02-01").cast("date").alias("o_orderdate"),
            (ids * 3.0).alias("o_totalprice"),
        ),
    }
    monkeypatch.setattr(fleet, "table", lambda spark, sf_dir, name: frames[name])
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    key, limit = "spark.sql.maxConcurrentOutputFileWriters", spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    landed = fleet.write_landing(spark, "", str(tmp_path / "a"), redelivered=True)
    winter = replace(fleet.fleet_spec(str(tmp_path / "b")), calendar=((1996, 12), (1997, 1)))
    held = fleet.land_months(spark, "", winter)
    plans = [p for p in map(str, (e.physicalPlanDescription() for e in _since(store, before))) if "file_number" in p]
    splits = [p for p in plans if "Insert" in p and "[file_number" in p]
    assert len(splits) == 4 and not any("Sort" in p for p in splits)
    rows = [spark.read.parquet(landed.file_path("yellow", month)).count() for month in landed.months]
    assert sum(rows) == 67 and sum(frame.count() for frame in held.values()) == 67 + 30
    assert spark.conf.get(key) == limit


def _since(store, before):
    found = store.executionsList()
    return [found.apply(i) for i in range(before, found.size())]
