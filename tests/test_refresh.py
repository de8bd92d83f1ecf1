"""Single months taken in anew, scopes over years, layouts and swaps."""

from __future__ import annotations

import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from helpers import multiset, own_schemas, plan
from tripmill import hourly_avg, hourly_passengers, landing_status, manifest, read_table, refresh, run
from tripmill.plans import refresh as refreshing
from tripmill.plans.fleet import by_pickup_month, deliver, fleet_spec, land_months, misread
from tripmill.sources import tables
from tripmill.sources.drifted import SchemaGrewError
from tripmill.spec import PipelineSpec

SERVICES = ("yellow", "green")


def published(spark, spec):
    """Rows of silver and gold, order and ingest times aside."""
    names = [spec.silver_table(s) for s in SERVICES] + [spec.consumption_table("yellow"), spec.trips_table]
    return {name.table: multiset(read_table(spark, name)) for name in names}


def bronze_rows(spark, spec, service):
    return multiset(read_table(spark, spec.bronze_table(service)).drop("_ingested_at"))


def files(spark, spec, tables_of=None):
    """Every data file of the published tables, with when it was written."""
    found = {}
    for name in tables_of or spec.tables:
        for uri in read_table(spark, name).inputFiles():
            found[uri] = os.stat(uri.replace("file://", "")).st_mtime_ns
    return found


@pytest.fixture()
def fleet(spark, sf_dir, tmp_path, request):
    """Five months landed by pickup month, March wrong; built once."""
    spec = replace(
        fleet_spec(str(tmp_path / "landing")),
        refreshable=True,
        by_service=request.param == "by_service",
        swap="view" if request.param == "view" else "rename",
    )
    spec = own_schemas(spec)
    held = land_months(spark, sf_dir, spec)
    held = {k: spark.createDataFrame(v.collect(), v.schema) for k, v in held.items()}
    for service in SERVICES:
        deliver(misread(held[service, (1997, 3)]), spec, service, (1997, 3))
    run(spark, spec, str(tmp_path / "tables"))
    return spec, held, tmp_path


def layouts(*names):
    return pytest.mark.parametrize("fleet", names, indirect=True)


@layouts("plain", "by_service", "view")
def test_a_refresh_equals_a_full_build(spark, fleet):
    spec, held, tmp_path = fleet
    wrong, before = published(spark, spec), files(spark, spec)
    for service in SERVICES:
        deliver(held[service, (1997, 3)], spec, service, (1997, 3))
    report = refresh(spark, spec, [3], str(tmp_path / "tables"), check_footers=True)
    own = replace(own_schemas(spec), refreshable=True)
    full = run(spark, own, str(tmp_path / "full"))
    assert published(spark, spec) == published(spark, own) != wrong
    for service in SERVICES:
        assert bronze_rows(spark, spec, service) == bronze_rows(spark, own, service)
        assert report.landed[service] == {"1997-03": held[service, (1997, 3)].count()}
        # Late February pickups were in the file, too.
        assert set(report.months[service]) == {"1997-02", "1997-03"}
        audit = full.audits[service]
        trips = read_table(spark, own.silver_table(service)).groupBy("pickup_month").count()
        for r in trips.filter(F.col("pickup_month").isin(list(report.months[service]))).collect():
            assert report.months[service][r.pickup_month].kept == r["count"]
        assert audit.raw == sum(1 for _ in bronze_rows(spark, spec, service))
    assert any(a.duplicates for a in report.months["yellow"].values())
    # Files of other months are the ones that were there before.
    after = files(spark, spec)
    untouched = {u for u in before if not any(m in u for m in ("month=1997-02", "month=1997-03"))}
    untouched |= {u for u in before if "landed_month=1997-02" in u}
    assert untouched and all(after.get(u) == before[u] for u in untouched)
    assert not {u for u in after if u not in before and not any(m in u for m in ("=1997-02", "=1997-03"))}
    refresh(spark, spec, [1, (1997, 5)], str(tmp_path / "tables"))
    assert published(spark, spec) == published(spark, own)


@layouts("by_service")
def test_months_that_lose_all_rows_are_dropped(spark, fleet):
    spec, held, tmp_path = fleet
    for service in SERVICES:
        # Late March pickups are in April's file; nothing is left but one row out of scope.
        rows = held[service, (1997, 3)]
        gone = rows.limit(1).withColumn(spec.service(service).pickup_col, F.lit("2001-01-01").cast("timestamp_ntz"))
        for month in (3, 4):
            deliver(gone, spec, service, (1997, month))
    report = refresh(spark, spec, [3, 4], str(tmp_path / "tables"))
    for service in SERVICES:
        assert report.months[service]["1997-03"].kept == 0
    for name in (spec.silver_table("yellow"), spec.consumption_table("yellow"), spec.trips_table):
        months = {r.pickup_month for r in read_table(spark, name).select("pickup_month").distinct().collect()}
        assert "1997-03" not in months and "1997-01" in months
        assert "1997-03" not in tables.partition_values(spark, name, "pickup_month")


class Died(Exception):
    pass


@layouts("view")
@pytest.mark.parametrize("step", ["bronze", "silver", "gold"])
def test_a_refresh_that_dies_is_completed_by_the_next(spark, fleet, monkeypatch, step):
    spec, held, tmp_path = fleet
    for service in SERVICES:
        deliver(held[service, (1997, 3)], spec, service, (1997, 3))
    real = refreshing.insert_partitions

    def dying(df, table, *args, **kwargs):
        if table.schema == getattr(spec, f"{step}_schema"):
            raise Died
        return real(df, table, *args, **kwargs)

    with monkeypatch.context() as patch:
        patch.setattr(refreshing, "insert_partitions", dying)
        with pytest.raises(Died):
            refresh(spark, spec, [3], str(tmp_path / "tables"))
    # The next refresh names another month, unless bronze itself still has to be read.
    refresh(spark, spec, [3] if step == "bronze" else [5], str(tmp_path / "tables"))
    own = own_schemas(spec)
    run(spark, own, str(tmp_path / "full"))
    assert published(spark, spec) == published(spark, own)


@layouts("plain")
def test_what_a_refresh_cannot_do_is_refused(spark, fleet):
    spec, held, tmp_path = fleet
    before = published(spark, spec)
    with pytest.raises(ValueError, match="refreshable"):
        refresh(spark, replace(spec, refreshable=False, monthly_layout=True), [3])
    with pytest.raises(ValueError, match="months of the spec"):
        refresh(spark, spec, [(1998, 3)])
    with pytest.raises(ValueError, match="months of the spec"):
        refresh(spark, spec, [])
    with pytest.raises(ValueError, match="outside the scope"):
        refresh(spark, replace(spec, months=(2, 3)), [3])
    deliver(held["green", (1997, 2)].withColumn("tip", F.lit(1.0)), spec, "green", (1997, 2))
    with pytest.raises(SchemaGrewError, match="tip"):
        refresh(spark, spec, [2], str(tmp_path / "tables"))
    assert published(spark, spec) == before


def test_the_next_year_is_added(spark, sf_dir, tmp_path):
    winter = ((1997, 2), (1996, 12), (1997, 1), (1996, 11))
    spec = own_schemas(replace(fleet_spec(str(tmp_path / "landing")), calendar=winter, refreshable=True))
    land_months(spark, sf_dir, spec)
    first = replace(spec, calendar=((1996, 11), (1996, 12)))
    run(spark, first, str(tmp_path / "tables"))
    kept = files(spark, first, [spec.silver_table("yellow")])
    refresh(spark, spec, [(1997, 1), (1997, 2)], str(tmp_path / "tables"))
    own = own_schemas(spec)
    run(spark, own, str(tmp_path / "full"))
    assert published(spark, spec) == published(spark, own)
    now = files(spark, spec, [spec.silver_table("yellow")])
    # Late December pickups came with January's file; November's partition is as it was.
    assert all(now[u] == t for u, t in kept.items() if "1996-11" in u)
    months = {r.pickup_month for r in read_table(spark, spec.trips_table).select("pickup_month").distinct().collect()}
    assert months == {"1996-11", "1996-12", "1997-01", "1997-02"}
    trips = read_table(spark, spec.trips_table)
    january = hourly_passengers(spark, spec, (1997, 1)).collect()
    assert january == hourly_avg(trips, 1997, 1, min_value=1).collect() and january


def test_a_calendar_drives_manifest_and_scope(spark):
    spec = PipelineSpec("/l", calendar=((2024, 1), (2023, 12), (2024, 3)))
    assert spec.periods == ((2023, 12), (2024, 1), (2024, 3))
    assert [str(d) for d in spec.scope] == ["2023-12-01", "2024-04-01"]
    exact = replace(spec, exact_months=True)
    assert [[str(d) for d in r] for r in exact.scope_ranges] == [["2023-12-01", "2024-02-01"], ["2024-03-01", "2024-04-01"]]
    rows = manifest(spark, spec).filter("service = 'green'").orderBy("file").collect()
    assert [(r.month, r.file) for r in rows] == [
        (12, "green_tripdata_2023-12.parquet"),
        (1, "green_tripdata_2024-01.parquet"),
        (3, "green_tripdata_2024-03.parquet"),
    ]
    assert [r.month for r in landing_status(spark, spec).collect()] == [12, 1, 3] * 2
    assert PipelineSpec("/l", year=2020, months=(2, 1)).periods == ((2020, 2), (2020, 1))
    for bad in (((2023, 13),), ((2023, 1), (2023, 1))):
        with pytest.raises(ValueError, match="month"):
            PipelineSpec("/l", calendar=bad)
    with pytest.raises(ValueError, match="by_service"):
        PipelineSpec("/l", by_service=True)
    with pytest.raises(ValueError, match="swap"):
        PipelineSpec("/l", swap="copy")


def test_service_and_month_both_prune(spark, sf_dir, tmp_path):
    from tripmill.plans.registered import queries

    result = queries()["yellow_hours"](spark, sf_dir)
    filters = plan(result).split("PartitionFilters: [")[1].split("]")[0]
    assert "service_type" in filters and "pickup_month" in filters
    assert result.collect()


def test_late_pickups_are_in_the_next_file(spark, sf_dir):
    spec = fleet_spec("/l")
    rows = by_pickup_month(spark, sf_dir, spec, "green")
    assert rows.count() == spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    odd = rows.filter("hour(lpep_pickup_datetime) = 7 AND lpep_pickup_datetime >= '1997-02-01' AND lpep_pickup_datetime < '1997-03-01'")
    assert {r.file_number for r in odd.collect()} == {2}


@pytest.fixture()
def target(spark, tmp_path):
    spec = own_schemas(PipelineSpec("/l", swap="view"))
    tables.bootstrap(spark, spec, str(tmp_path))
    return spec, spec.bronze_table("yellow")


def test_a_view_swap_moves_no_file(spark, target, monkeypatch):
    spec, table = target
    monkeypatch.setattr(tables, "_rename", lambda *a: pytest.fail("a table was renamed"))
    statements = []
    real = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, q, *a, **k: (statements.append(q), real(self, q, *a, **k))[1])
    tables.overwrite_table(spark.range(5), table, swap="view")
    written = files(spark, spec, [table])
    tables.overwrite_table(spark.range(3).select(F.lit("x").alias("name")), table, swap="view")
    assert read_table(spark, table).dtypes == [("name", "string")]
    assert tables.row_count(spark, table) == 3
    assert not any(os.path.exists(u.replace("file://", "")) for u in written)
    assert not [q for q in statements if "RENAME" in q or "LOCATION" in q]
    tables.overwrite_table(spark.range(8).select("id", (F.col("id") % 2).alias("p")), table, partition_by=["p"], swap="view")
    assert "PartitionFilters: [isnotnull(p" in plan(read_table(spark, table).filter("p = 1"))
    assert tables.partition_values(spark, table, "p") == {"0", "1"}


@pytest.mark.parametrize("step", ["write", "view", "drop"])
@pytest.mark.parametrize("first", [True, False])
def test_a_view_swap_that_dies_leaves_the_table(spark, target, monkeypatch, step, first):
    spec, table = target
    if not first:
        tables.overwrite_table(spark.range(8), table, swap="view")
    real = type(spark).sql

    def dying(self, query, *args, **kwargs):
        if (step == "view" and query.startswith("CREATE OR REPLACE VIEW")) or (step == "drop" and query.startswith("DROP TABLE")):
            raise Died
        return real(self, query, *args, **kwargs)

    rows = spark.range(3)
    if step == "write":
        rows = rows.select(F.when(F.col("id") < 9, F.raise_error(F.lit("boom"))).cast("long").alias("id"))
    with monkeypatch.context() as patch:
        patch.setattr(type(spark), "sql", dying)
        try:
            tables.overwrite_table(rows, table, swap="view")
        except Exception as error:  # noqa: BLE001
            assert isinstance(error, Died) or "boom" in str(error)
        else:
            assert step == "drop" and first  # nothing to drop
    new = step == "drop"
    if not first or new:
        assert tables.row_count(spark, table) == (3 if new else 8)
    tables.bootstrap(spark, spec)
    names = {t.name for t in spark.catalog.listTables(spec.bronze_schema) if not t.isTemporary}
    if first and not new:
        assert not names
    else:
        assert tables.row_count(spark, table) == (3 if new else 8)
        assert len(names) == 2  # the view and its rows
    tables.overwrite_table(spark.range(2), table, swap="view")
    assert tables.row_count(spark, table) == 2


def test_a_table_is_not_turned_into_a_view_unasked(spark, target):
    spec, table = target
    tables.overwrite_table(spark.range(5), table)
    with pytest.raises(ValueError, match="is a table"):
        tables.overwrite_table(spark.range(3), table, swap="view")
    assert tables.row_count(spark, table) == 5


def test_partitions_are_replaced_in_dynamic_mode_only(spark, target):
    spec, table = target
    tables.overwrite_table(spark.range(4).withColumn("p", F.lit("a")), table, partition_by=["p"], swap="view")
    with pytest.raises(ValueError, match="dynamic"):
        tables.insert_partitions(spark.range(4).withColumn("p", F.lit("b")), table)
