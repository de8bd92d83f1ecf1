from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import multiset, plan, read_schemas, scans
from tripmill import SourceFile, conform_union, drift_report, scan_conformed
from tripmill.operators.conform import ColumnCaseError, union_all
from tripmill.plans.fleet import landed_fleet, yellow_trips
from tripmill.plans.medallion import source_files
from tripmill.sources.drifted import file_schemas
from tripmill.sources.landing import NestedFilesError


def write(df, path):
    df.coalesce(1).write.parquet(str(path))
    return SourceFile(str(path))


def per_file(spark, files):
    return conform_union(
        [spark.read.parquet(f.path).withColumn("_source_file", F.lit(f.name)) for f in files]
    )


def test_union_promotes_fills_and_keeps_first_seen_order(spark):
    a = spark.createDataFrame([(1, "x")], "VendorID int, note string")
    b = spark.createDataFrame([(2, 2.5)], "vendorid bigint, Fee double")
    c = spark.createDataFrame([(None, 3)], "fee float, VENDORID int")
    result = conform_union([a, b, c])
    assert result.dtypes == [("vendorid", "bigint"), ("note", "string"), ("fee", "double")]
    assert {tuple(r) for r in result.collect()} == {(1, "x", None), (2, None, 2.5), (3, None, None)}


def test_mixed_types_become_string(spark):
    a = spark.sql("SELECT 1 AS k, DATE'2023-01-01' AS d, CAST(1 AS DECIMAL(5,1)) AS m, NULL AS n")
    b = spark.sql("SELECT 'b' AS k, TIMESTAMP_NTZ'2023-01-02 03:00:00' AS d, 2 AS m, NULL AS n")
    result = conform_union([a, b])
    assert [t for _, t in result.dtypes] == ["string"] * 4
    assert [tuple(r) for r in result.orderBy("k").collect()] == [
        ("1", "2023-01-01", "1.0", None),
        ("b", "2023-01-02 03:00:00", "2", None),
    ]


def test_columns_differing_by_case_in_one_frame_are_refused(spark):
    frame = spark.range(1).toDF("x").select(
        F.col("x").alias("Airport_fee"), F.col("x").alias("airport_fee")
    )
    with pytest.raises(ColumnCaseError, match="'Airport_fee' and 'airport_fee'"):
        conform_union([frame])


def test_nothing_to_union_is_an_error(spark):
    with pytest.raises(ValueError, match="no input files"):
        conform_union([])
    with pytest.raises(ValueError, match="no input files"):
        scan_conformed(spark, [])


def test_odd_column_names_survive(spark):
    frame = spark.range(2).select(F.col("id").alias("a.b `c"))
    assert conform_union([frame, frame]).columns == ["a.b `c"]


def test_many_frames_become_one_union(spark):
    frames = [spark.range(i, i + 1).select(F.col("id").cast("int")) for i in range(9)]
    result = union_all(frames)
    assert plan(result).count("Union") == 1
    assert sorted(r[0] for r in result.collect()) == list(range(9))


@pytest.fixture(scope="module")
def landed(spark, sf_dir):
    return source_files(landed_fleet(spark, sf_dir), "yellow")


@pytest.mark.parametrize("footers", ["auto", "executors"])
def test_grouped_scan_equals_file_by_file(spark, landed, footers):
    grouped = scan_conformed(spark, landed, footers=footers)
    reference = per_file(spark, landed)
    assert grouped.schema == reference.schema
    assert grouped.exceptAll(reference).isEmpty() and reference.exceptAll(grouped).isEmpty()
    assert scans(grouped) == 2 and scans(reference) == 5


def test_bronze_column_order(spark, landed):
    assert scan_conformed(spark, landed).columns == [
        "vendorid",
        "passenger_count",
        "tpep_pickup_datetime",
        "tpep_dropoff_datetime",
        "total_amount",
        "airport_fee",
        "_source_file",
    ]
    # The fee is first seen in a later file when file 3, which lacks it, comes first.
    assert scan_conformed(spark, [landed[2], *landed[:2]]).columns[-2:] == [
        "_source_file",
        "airport_fee",
    ]


def test_file_order_changes_neither_rows_nor_types(spark, landed):
    a, b = scan_conformed(spark, landed), scan_conformed(spark, landed[::-1])
    assert dict(a.dtypes) == dict(b.dtypes)
    assert a.exceptAll(b.select(a.columns)).isEmpty()


def test_no_row_is_lost_or_added(spark, landed, sf_dir):
    assert scan_conformed(spark, landed).count() == yellow_trips(spark, sf_dir, False).count()


def test_only_asked_for_columns_are_read(spark, landed):
    narrow = scan_conformed(spark, landed).select("total_amount")
    # Spark may add its own row-index pseudo column to a scan that offers metadata.
    for schema in read_schemas(narrow):
        data = [c for c in schema[7:-1].split(",") if not c.startswith("_tmp_metadata")]
        assert data == ["total_amount:double"]


def test_case_sensitive_sessions_give_the_same_rows(spark, landed):
    insensitive = multiset(scan_conformed(spark, landed))
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        assert multiset(scan_conformed(spark, landed)) == insensitive
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


@pytest.mark.parametrize("footers", ["auto", "executors"])
def test_plain_files_and_deep_folders_name_their_source(spark, tmp_path, footers):
    import pyarrow as pa
    import pyarrow.parquet as pq

    root = tmp_path / "yellow"
    root.mkdir()
    pq.write_table(pa.table({"k": pa.array([1, 2], pa.int32())}), root / "a_2023-01.parquet")
    spark.range(3).select(F.col("id").alias("K")).write.parquet(
        str(root / "a_2023-02.parquet" / "inner")
    )
    files = [
        SourceFile(str(root / "a_2023-01.parquet")),
        SourceFile(str(root / "a_2023-02.parquet" / "inner")),
    ]
    # Files of one table share a folder.
    with pytest.raises(ValueError, match="share a folder"):
        scan_conformed(spark, files, footers=footers)
    files[1] = SourceFile(str(root / "a_2023-03.parquet"))
    spark.range(3).select(F.col("id").alias("K")).repartition(3).write.parquet(files[1].path)
    rows = scan_conformed(spark, files, footers=footers).groupBy("_source_file").count().collect()
    assert {tuple(r) for r in rows} == {("a_2023-01.parquet", 2), ("a_2023-03.parquet", 3)}


def test_drift_inside_a_folder_is_found_by_reading_all_footers(spark, tmp_path):
    folder = str(tmp_path / "yellow" / "a_2023-01.parquet")
    spark.range(3).select(F.col("id").cast("int").alias("k")).write.parquet(folder)
    spark.range(3, 5).select(F.col("id").cast("double").alias("K")).write.mode("append").parquet(
        folder
    )
    files = [SourceFile(folder)]
    schemas = file_schemas(spark, files, "executors")
    assert {s.schema["k"].dataType for s in schemas} == {T.IntegerType(), T.DoubleType()}
    result = scan_conformed(spark, files, footers="executors")
    assert dict(result.dtypes)["k"] == "double"
    assert sorted(r.k for r in result.collect()) == [0, 1, 2, 3, 4]
    assert {r._source_file for r in result.collect()} == {"a_2023-01.parquet"}


def test_unreadable_and_absent_files_are_named(spark, tmp_path):
    root = tmp_path / "yellow"
    root.mkdir()
    good = write(spark.range(1), root / "a_2023-01.parquet")
    (root / "a_2023-02.parquet").write_bytes(b"PAR1 cut short")
    with pytest.raises(ValueError, match="a_2023-02.parquet"):
        scan_conformed(
            spark, [good, SourceFile(str(root / "a_2023-02.parquet"))], footers="executors"
        )
    with pytest.raises(ValueError, match="a_2023-09.parquet"):
        scan_conformed(
            spark, [good, SourceFile(str(root / "a_2023-09.parquet"))], footers="executors"
        )


# Every stored type a column may have, and a way to fill it.
FILLED = {
    **{
        name: f"CAST(id AS {name})"
        for name in ("tinyint", "smallint", "int", "bigint", "float", "double", "string")
    },
    "decimal(9,2)": "CAST(id AS DECIMAL(9,2))",
    "decimal(12,1)": "CAST(id AS DECIMAL(12,1))",
    "boolean": "id > 0",
    "date": "date_add(DATE'2023-01-31', CAST(id AS INT))",
    "timestamp": "TIMESTAMP'2023-01-31 10:00:00' + id * INTERVAL '1' HOUR",
    "timestamp_ntz": "TIMESTAMP_NTZ'2023-01-31 10:00:00' + id * INTERVAL '1' HOUR",
}


@pytest.mark.parametrize("footers", ["auto", "executors"])
def test_every_kind_of_mix_reads(spark, tmp_path, footers):
    """One column per pair of types over two files: grouping must avoid unreadable pairs."""
    pairs = [(a, b) for a in FILLED for b in FILLED]
    base = spark.range(-2, 3)
    root = tmp_path / "yellow"
    one = write(
        base.select([F.expr(FILLED[a]).alias(f"c{i}") for i, (a, _) in enumerate(pairs)]),
        root / "a_2023-01.parquet",
    )
    two = write(
        base.select([F.expr(FILLED[b]).alias(f"C{i}") for i, (_, b) in enumerate(pairs)]),
        root / "a_2023-02.parquet",
    )
    grouped = scan_conformed(spark, [one, two], footers=footers)
    reference = per_file(spark, [one, two])
    assert grouped.schema == reference.schema
    assert multiset(grouped) == multiset(reference)


COLUMN = st.tuples(
    st.sampled_from(["k", "K", "fee", "Fee", "FEE", "note"]),
    st.sampled_from(["tinyint", "int", "bigint", "float", "double", "string", "date"]),
)
FILE = st.lists(COLUMN, min_size=1, max_size=4, unique_by=lambda c: c[0].lower())


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(FILE, st.integers(0, 4)), min_size=1, max_size=5))
def test_any_drift_keeps_every_row(spark, tmp_path_factory, drifting):
    """Grouped scan and frame-by-frame union agree on whatever files turn up."""
    root = tmp_path_factory.mktemp("drift") / "yellow"
    files = []
    for i, (columns, rows) in enumerate(drifting):
        frame = spark.range(rows).select([F.expr(FILLED[t]).alias(n) for n, t in columns])
        files.append(write(frame, root / f"a_2023-{i + 1:02d}.parquet"))
    grouped, reference = scan_conformed(spark, files), per_file(spark, files)
    assert grouped.schema == reference.schema
    assert multiset(grouped) == multiset(reference)
    assert grouped.count() == sum(rows for _, rows in drifting)
    backwards = scan_conformed(spark, files[::-1])
    assert dict(backwards.dtypes) == dict(grouped.dtypes)
    assert multiset(backwards) == multiset(grouped)


def test_lossless_mode_reaches_the_scan(spark, tmp_path):
    big = 2**24 + 1
    root = tmp_path / "yellow"
    one = write(spark.createDataFrame([(big,)], "k int"), root / "a_2023-01.parquet")
    two = write(spark.createDataFrame([(1.5,)], "k float"), root / "a_2023-02.parquet")
    rounded = {r.k for r in scan_conformed(spark, [one, two]).collect()}
    exact = {r.k for r in scan_conformed(spark, [one, two], lossless=True).collect()}
    assert rounded == {float(big - 1), 1.5} and exact == {float(big), 1.5}


@pytest.mark.parametrize("footers", ["auto", "executors"])
def test_drift_report(spark, landed, footers):
    rows = {r.column_name: r for r in drift_report(spark, landed, footers=footers).collect()}
    assert rows["passenger_count"].types == "bigint, double, int"
    assert rows["airport_fee"].files == 4
    assert rows["airport_fee"].rows < rows["vendorid"].rows
    assert not any(r.fell_back for r in rows.values())


def test_drift_report_flags_string_fallback(spark, tmp_path):
    root = tmp_path / "yellow"
    one = write(spark.sql("SELECT 1 AS k, 'a' AS s"), root / "a_2023-01.parquet")
    two = write(spark.sql("SELECT 'x' AS k, 'b' AS s"), root / "a_2023-02.parquet")
    rows = {r.column_name: r.fell_back for r in drift_report(spark, [one, two]).collect()}
    assert rows == {"k": True, "s": False}


def test_many_files_are_tagged_right(spark, tmp_path):
    """More files than one scan tags, with a name that begins with another name."""
    root = tmp_path / "yellow"
    names = [f"a_{year}-{month:02d}.parquet" for year in (2023, 2024) for month in range(1, 8)]
    names.append("a_2023-01.parquet.late")
    files = []
    for i, name in enumerate(names):
        rows = spark.range(i + 1).withColumn("n", F.lit(name))
        # Folders of part files and plain files, side by side.
        if i % 2:
            rows.repartition(2).write.parquet(str(root / name))
        else:
            rows.toPandas().to_parquet(_made(root) / name, index=False)
        files.append(SourceFile(str(root / name)))
    for footers in ("auto", "executors"):
        if footers == "executors":
            files, names = files[:-1], names[:-1]
        result = scan_conformed(spark, files, footers=footers)
        assert scans(result) == 2
        assert result.filter("n <> _source_file").isEmpty()
        assert result.select("_source_file").distinct().count() == len(names)


def _made(folder):
    folder.mkdir(exist_ok=True)
    return folder


def test_empty_files(spark, tmp_path):
    root = tmp_path / "yellow"
    one = write(spark.range(0), root / "a_2023-01.parquet")
    two = write(spark.range(0), root / "a_2023-02.parquet")
    assert scan_conformed(spark, [one, two]).isEmpty()
    three = write(spark.range(4), root / "a_2023-03.parquet")
    rows = scan_conformed(spark, [one, two, three]).select("_source_file").collect()
    assert [r[0] for r in rows] == ["a_2023-03.parquet"] * 4


@pytest.mark.parametrize("footers", ["auto", "executors"])
def test_columns_of_every_part_are_found(spark, tmp_path, footers):
    folder = str(tmp_path / "yellow" / "a_2023-01.parquet")
    spark.range(3).coalesce(1).write.parquet(folder)
    wider = spark.range(3, 5).withColumn("tip", F.lit(1.5))
    wider.coalesce(1).write.mode("append").parquet(folder)
    result = scan_conformed(spark, [SourceFile(folder)], footers=footers)
    assert result.columns == ["id", "tip", "_source_file"] or footers == "executors"
    assert {(r.id, r.tip) for r in result.collect()} == {(i, None if i < 3 else 1.5) for i in range(5)}


@pytest.mark.parametrize("footers", ["auto", "executors"])
def test_parts_of_any_name_count(spark, tmp_path, footers):
    """Mixed types, a part without a suffix and one under another name: every row is read."""
    folder = tmp_path / "yellow" / "a_2023-01.parquet"
    for n, kind in ((2, "int"), (1, "bigint"), (4, "string")):
        rows = spark.range(n).select(F.col("id").cast(kind).alias("k"))
        rows.coalesce(1).write.mode("append").parquet(str(folder))
    parts = sorted(folder.glob("part-*.parquet"))
    parts[0].rename(folder / "part-c")
    parts[1].rename(folder / "b.pq")
    for leftover in folder.glob(".part-*.crc"):
        leftover.rename(tmp_path / leftover.name)
    files = [SourceFile(str(folder))]
    assert scan_conformed(spark, files, footers=footers).count() == 7
    assert drift_report(spark, files, footers=footers).first().rows == 7


def test_widening_parts_need_no_path_list(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "yellow" / "a_2023-01.parquet")
    for kind in ("int", "bigint"):
        rows = spark.range(3).select(F.col("id").cast(kind).alias("k"))
        rows.coalesce(1).write.mode("append").parquet(folder)
    result = scan_conformed(spark, [SourceFile(folder)])
    assert dict(result.dtypes)["k"] == "bigint" and result.count() == 6
    assert scans(result) == 1


def test_folders_inside_a_logical_file_are_refused(spark, tmp_path):
    folder = str(tmp_path / "yellow" / "a_2023-01.parquet")
    spark.range(3).write.parquet(folder)
    spark.range(3).write.parquet(f"{folder}/sub")
    with pytest.raises(NestedFilesError, match="/sub/"):
        scan_conformed(spark, [SourceFile(folder)], footers="executors")


def test_one_file_needs_no_path_at_all(spark, tmp_path):
    one = write(spark.range(3), tmp_path / "yellow" / "a_2023-01.parquet")
    result = scan_conformed(spark, [one])
    assert "_metadata" not in plan(result) and "file_path" not in plan(result)
    assert {r._source_file for r in result.collect()} == {"a_2023-01.parquet"}


def test_a_raw_source_file_column_is_replaced(spark, tmp_path):
    root = tmp_path / "yellow"
    one = write(spark.sql("SELECT 1 AS k, 'old' AS _Source_File"), root / "a_2023-01.parquet")
    two = write(spark.sql("SELECT 2 AS k"), root / "a_2023-02.parquet")
    rows = {tuple(r) for r in scan_conformed(spark, [one, two]).collect()}
    assert rows == {(1, "a_2023-01.parquet"), (2, "a_2023-02.parquet")}


def test_file_names_must_be_plain():
    with pytest.raises(ValueError, match="letters"):
        SourceFile("/data/yellow/a b.parquet")


def test_the_folder_must_have_a_plain_name(spark, tmp_path):
    one = write(spark.range(1), tmp_path / "my files" / "a_2023-01.parquet")
    with pytest.raises(ValueError, match="the folder needs a name"):
        scan_conformed(spark, [one])
