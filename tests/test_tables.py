from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from helpers import own_schemas, spec_for
from tripmill import bootstrap, overwrite_table, read_table, row_count
from tripmill.sources import tables
from tripmill.sources.session import scratch_dir, sized_settings, sql_conf
from tripmill.sources.tables import overwrite_counted


@pytest.fixture(scope="module")
def spec(spark, tmp_path_factory):
    spec = own_schemas(spec_for())
    location = str(tmp_path_factory.mktemp("tables"))
    bootstrap(spark, spec, location)
    bootstrap(spark, spec, location)  # repeating it is harmless
    return spec


def tables_in(spark, schema):
    return {t.name for t in spark.catalog.listTables(schema) if not t.isTemporary}


def test_overwrite_replaces_rows_and_schema(spark, spec):
    target = spec.table(spec.silver_schema, "t")
    overwrite_table(spark.range(5), target)
    assert row_count(spark, target) == 5
    overwrite_table(spark.range(3).select(F.lit("x").alias("name")), target)
    assert read_table(spark, target).dtypes == [("name", "string")]
    assert row_count(spark, target) == 3
    assert tables_in(spark, spec.silver_schema) == {"t"}


def test_a_failed_overwrite_leaves_the_old_table(spark, spec):
    target = spec.table(spec.gold_schema, "safe")
    overwrite_table(spark.range(5), target)
    broken = spark.range(5).select(F.raise_error(F.lit("boom")).alias("id"))
    with pytest.raises(PySparkException):
        overwrite_table(broken, target)
    assert row_count(spark, target) == 5
    overwrite_table(spark.range(2), target)
    assert row_count(spark, target) == 2


def test_a_table_can_be_rebuilt_from_itself(spark, spec):
    target = spec.table(spec.gold_schema, "self")
    overwrite_table(spark.range(4), target)
    overwrite_table(read_table(spark, target).filter("id > 1"), target)
    assert row_count(spark, target) == 2


def test_counted_overwrite(spark, spec):
    target = spec.table(spec.bronze_schema, "counted")
    frame = spark.range(100).select((F.col("id") % 7).alias("k"))
    counts = overwrite_counted(
        frame.groupBy("k").agg(F.count(F.lit(1)).alias("copies")),
        target,
        {"kept": F.count(F.lit(1)), "all": F.sum("copies")},
        drop=["copies"],
    )
    assert counts == {"kept": 7, "all": 100}
    assert read_table(spark, target).columns == ["k"]


def test_counting_nothing_gives_zero(spark, spec):
    target = spec.table(spec.bronze_schema, "nothing")
    counts = overwrite_counted(spark.range(0), target, {"n": F.count(F.lit(1)), "s": F.sum("id")})
    assert counts == {"n": 0, "s": 0}


def test_partitioned_overwrite(spark, spec):
    target = spec.table(spec.silver_schema, "parts")
    frame = spark.range(10).select("id", (F.col("id") % 2).alias("p"))
    overwrite_table(frame, target, partition_by=["p"])
    assert spark.sql(f"SHOW PARTITIONS {target}").count() == 2
    assert row_count(spark, target) == 10


def test_settings_follow_the_input_size(spark):
    small, large = sized_settings(spark, 10**9), sized_settings(spark, 10**14)
    split, width = "spark.sql.files.maxPartitionBytes", "spark.sql.shuffle.partitions"
    assert int(small[split]) == 128 * 2**20 and int(small[width]) == 8
    assert int(large[split]) == 500_000_000 and int(large[width]) == 40_000


def test_sql_conf_restores(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with pytest.raises(RuntimeError), sql_conf(spark, {key: "3", "spark.sql.tripmill.x": "1"}):
        assert spark.conf.get(key) == "3"
        raise RuntimeError
    assert spark.conf.get(key) == before
    assert spark.conf.get("spark.sql.tripmill.x", None) is None


class FakeSession:
    """Just the two things scratch_dir reads; the real setting cannot change in a session."""

    class sparkContext:
        applicationId = "app-1"
        master = "local[2]"

    def __init__(self, folder):
        self.conf = {"spark.checkpoint.dir": folder}


def test_scratch_space_is_in_the_shared_folder():
    shared = FakeSession("hdfs://cluster/shared/")
    path = scratch_dir(shared, "landing")
    assert path.startswith("hdfs://cluster/shared/tripmill/app-1/landing-")
    assert path != scratch_dir(shared, "landing")


def test_scratch_space_without_a_shared_folder_is_local():
    assert "/tripmill-" in scratch_dir(FakeSession(None), "landing")


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]"])
def test_a_cluster_must_name_a_shared_folder(monkeypatch, master):
    monkeypatch.setattr(FakeSession.sparkContext, "master", master)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(FakeSession(None), "landing")


class Died(Exception):
    pass


@pytest.mark.parametrize("step", range(4))
@pytest.mark.parametrize("partition_by", [[], ["p"]])
def test_a_swap_that_dies_leaves_a_table(spark, spec, monkeypatch, step, partition_by):
    """Die after each statement of the swap: old or new rows are there after the next bootstrap."""
    target = spec.table(spec.bronze_schema, spec.bronze_table("yellow").table)
    frame = spark.range(8).select("id", (F.col("id") % 2).alias("p"))
    overwrite_table(frame, target, partition_by=partition_by)
    seen = []

    def dying(*args, real):
        if len(seen) == step:
            raise Died
        seen.append(args)
        return real(*args)

    with monkeypatch.context() as patch:
        real = tables._rename
        patch.setattr(tables, "_rename", lambda *a: dying(*a, real=real))
        drop = type(spark).sql
        patch.setattr(
            type(spark), "sql",
            lambda self, q, *a, **k: dying(self, q, real=drop) if q.startswith("DROP TABLE") and "__previous_" in q else drop(self, q, *a, **k),
        )
        try:
            overwrite_table(frame.limit(3), target, partition_by=partition_by)
        except Died:
            assert step < 3
        else:
            assert step == 3
    bootstrap(spark, spec)
    assert row_count(spark, target) == (8 if step < 2 else 3)
    names = [t.name for t in spark.catalog.listTables(f"{spec.catalog}.{spec.bronze_schema}")]
    assert [n for n in names if n.startswith(target.table)] == [target.table]
