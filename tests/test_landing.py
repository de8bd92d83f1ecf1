from __future__ import annotations

from dataclasses import replace
from pathlib import Path

import pytest

from helpers import spec_for
from tripmill import MissingFilesError, landing_status, manifest, require_landing
from tripmill.sources.landing import NestedFilesError, listing, missing_files


def land(spec, service, month, content=b"x" * 150_000):
    path = spec.file_path(service, month)
    import os

    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as out:
        out.write(content)
    return path


def land_parquet(spark, spec, service, month, rows):
    spark.range(rows).coalesce(1).write.parquet(spec.file_path(service, month))


@pytest.fixture
def spec(tmp_path):
    return spec_for(tmp_path / "landing", months=(1, 2))


def test_manifest_lists_every_service_and_month(spark, spec):
    rows = manifest(spark, spec).orderBy("service", "month").collect()
    assert [(r.service, r.month, r.file) for r in rows] == [
        ("green", 1, "green_tripdata_2023-01.parquet"),
        ("green", 2, "green_tripdata_2023-02.parquet"),
        ("yellow", 1, "yellow_tripdata_2023-01.parquet"),
        ("yellow", 2, "yellow_tripdata_2023-02.parquet"),
    ]
    assert rows[0].path == spec.file_path("green", 1)


def test_nothing_landed_yet(spark, spec):
    rows = landing_status(spark, spec).collect()
    assert [(r.present, r.size_mb) for r in rows] == [(False, None)] * 4
    with pytest.raises(MissingFilesError) as error:
        require_landing(spark, spec)
    assert len(error.value.missing) == 4


def test_gate_names_every_missing_file(spark, spec):
    land(spec, "yellow", 1)
    land(spec, "green", 2)
    land(spec, "green", 1, b"")
    with pytest.raises(MissingFilesError) as error:
        require_landing(spark, spec)
    assert error.value.missing == [
        "green/green_tripdata_2023-01.parquet",
        "yellow/yellow_tripdata_2023-02.parquet",
    ]
    assert "yellow/yellow_tripdata_2023-02.parquet" in str(error.value)


def test_complete_landing_reports_sizes(spark, spec):
    for service in ("yellow", "green"):
        for month in (1, 2):
            land(spec, service, month)
    land(spec, "yellow", 7)  # not expected, not counted
    rows = landing_status(spark, spec).collect()
    assert landing_status(spark, spec).dtypes == [
        ("service", "string"),
        ("month", "int"),
        ("file", "string"),
        ("present", "boolean"),
        ("size_mb", "double"),
    ]
    assert [(r.service, r.month, r.present, r.size_mb) for r in rows] == [
        ("green", 1, True, 0.2),
        ("green", 2, True, 0.2),
        ("yellow", 1, True, 0.2),
        ("yellow", 2, True, 0.2),
    ]
    assert require_landing(spark, spec).bytes == 600_000


def test_sizes_are_those_on_disk(spark, spec):
    for service in ("yellow", "green"):
        for month in (1, 2):
            spark.range(200_000 * month).repartition(2).write.parquet(spec.file_path(service, month))
    for row in landing_status(spark, spec).collect():
        parts = Path(spec.file_path(row.service, row.month)).glob("part-*")
        assert row.size_mb == round(sum(p.stat().st_size for p in parts) / 1e6, 1) > 0


def test_nested_parts_are_refused_by_name(spark, spec):
    for month in (1, 2):
        for service in ("yellow", "green"):
            land_parquet(spark, spec, service, month, 3)
    inner = spec.file_path("green", 3).replace("-03", "-02") + ".d"
    spark.range(2).write.parquet(inner)
    require_landing(spark, spec)  # not a logical file
    spark.range(2).write.parquet(spec.file_path("green", 1) + "_x/sub")
    require_landing(spark, spec)
    nested = replace(spec, months=(4,))
    for service in ("yellow", "green"):
        spark.range(2).write.parquet(nested.file_path(service, 4) + "/sub")
    assert not any(r.present for r in landing_status(spark, nested).collect())
    with pytest.raises(NestedFilesError, match="2023-04.parquet/sub/"):
        require_landing(spark, nested)


def test_missing_files_are_rows(spark, spec):
    land_parquet(spark, spec, "yellow", 1, 5)
    assert {tuple(r) for r in missing_files(spark, spec).collect()} == {
        ("yellow", "yellow_tripdata_2023-02.parquet"),
        ("green", "green_tripdata_2023-01.parquet"),
        ("green", "green_tripdata_2023-02.parquet"),
    }


def test_listing_tasks_do_not_follow_bytes(spark, spec):
    for month in (1, 2):
        for service in ("yellow", "green"):
            land_parquet(spark, spec, service, month, 500)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        tasks = listing(spark, spec.landing_root).rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert tasks <= 4 * spark.sparkContext.defaultParallelism


def test_gate_leaves_the_session_as_it_was(spark, spec):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    with pytest.raises(MissingFilesError):
        require_landing(spark, spec)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_folders_of_part_files_count_as_one_file(spark, spec):
    for service in ("yellow", "green"):
        for month in (1, 2):
            spark.range(30).repartition(3).write.parquet(spec.file_path(service, month))
    rows = landing_status(spark, spec, check_footers=True).collect()
    assert [r.rows for r in rows] == [30] * 4 and all(r.present for r in rows)


def test_a_truncated_file_passes_by_size_but_not_by_footer(spark, spec):
    for month in (1, 2):
        land_parquet(spark, spec, "yellow", month, 5)
    land_parquet(spark, spec, "green", 1, 7)
    land(spec, "green", 2, b"PAR1 and then nothing useful")
    assert all(r.present for r in landing_status(spark, spec).collect())
    checked = {(r.service, r.month): r for r in landing_status(spark, spec, True).collect()}
    assert checked["green", 2].present is False and checked["green", 2].rows is None
    assert checked["green", 1].rows == 7
    require_landing(spark, spec)
    with pytest.raises(MissingFilesError, match="green_tripdata_2023-02"):
        require_landing(spark, spec, check_footers=True)


def test_look_alike_names_in_the_root_do_not_matter(spark, tmp_path):
    root = tmp_path / "yellow" / "yellow_tripdata_2020-01.parquet" / "landing"
    spec = spec_for(root, months=(1,))
    land(spec, "yellow", 1)
    land(spec, "green", 1)
    assert all(r.present for r in landing_status(spark, spec).collect())
