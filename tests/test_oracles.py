"""Every registered query against its SQL, run by an independent engine."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_points
from tripmill.plans import oracles, registered

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(registered.queries()) == set(oracles.oracle_sql())
    assert set(registered.queries()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_query_equals_oracle(spark, duck, sf_dir, name):
    frame = entry_points.queries()[name](spark, sf_dir)
    oracle = duck.sql(entry_points.oracle_sql()[name])
    columns = sorted(frame.columns)
    assert columns == sorted(oracle.columns)
    order = [oracle.columns.index(c) for c in columns]
    expected = sorted((tuple(row[i] for i in order) for row in oracle.fetchall()), key=repr)
    got = sorted((tuple(row) for row in frame.select(columns).collect()), key=repr)
    assert got == expected and got


def test_entry(spark):
    result = entry_points.entry(spark)
    assert result.columns == ["month", "avg_total_amount", "trips"]
    assert result.count() == 5


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Beirut"])
@pytest.mark.parametrize(
    "name", ["q1_monthly_avg", "q2_hourly_avg", "q2_hourly_avg_sql", "landing_completeness"]
)
def test_queries_do_not_depend_on_the_session_zone(spark, sf_dir, name, zone):
    query = entry_points.queries()[name]
    utc = query(spark, sf_dir).collect()
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert query(spark, sf_dir).collect() == utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
