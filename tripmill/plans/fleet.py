"""Trip data derived from general-purpose tables.

The shared test tables hold no trips, so two services are derived row by row from them:
`lineitem` plays yellow and `orders` plays green. Every row of both tables becomes a trip.
"""

from __future__ import annotations

import atexit
import threading
import uuid
from collections.abc import Callable
from contextlib import AbstractContextManager
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.plans.medallion import run
from tripmill.sources.drifted import SourceFile
from tripmill.sources.landing import listing
from tripmill.sources.session import in_parallel, scratch_dir, sql_conf
from tripmill.spec import PipelineSpec

YEAR = 1997
MONTHS = (1, 2, 3, 4, 5)
FILES_PER_SERVICE = 5


def fleet_spec(landing_root: str = "") -> PipelineSpec:
    """The usual services over the months the derived trips are scoped to."""
    return PipelineSpec(landing_root=landing_root, year=YEAR, months=MONTHS)


def in_own_schemas(spec: PipelineSpec) -> PipelineSpec:
    """The same build in schemas nobody else uses."""
    prefix = f"tripmill_{uuid.uuid4().hex[:12]}"
    return replace(
        spec,
        bronze_schema=f"{prefix}_bronze",
        silver_schema=f"{prefix}_silver",
        gold_schema=f"{prefix}_gold",
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _trip(
    vendor: Column, passengers: Column, unknown: Column, day: Column, hours: Column,
    amount: Column, refunded: Column, file_number: Column, pickup: str, dropoff: str,
) -> list[Column]:
    starts = day + F.make_dt_interval(F.lit(0), hours.cast("int"))
    return [
        vendor.alias("vendorid"),
        F.when(~unknown, passengers).alias("passenger_count"),
        starts.alias(pickup),
        (starts + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(15))).alias(dropoff),
        F.when(refunded, -amount).otherwise(amount).alias("total_amount"),
        file_number.alias("file_number"),
    ]


def yellow_trips(spark: SparkSession, sf_dir: str, redelivered: bool = True) -> DataFrame:
    """All line items as yellow trips; the returned ones arrive a second time if asked."""
    delivered = table(spark, sf_dir, "lineitem")
    if redelivered:
        twice = F.when(F.col("l_returnflag") == "R", F.lit(2)).otherwise(F.lit(1))
        delivered = delivered.withColumn("delivery", F.explode(F.sequence(F.lit(1), twice)))
    return delivered.select(
        _trip(
            vendor=F.col("l_suppkey") % 2 + 1,
            passengers=F.col("l_quantity").cast("bigint") % 7,
            unknown=F.col("l_partkey") % 29 == 0,
            day=F.col("l_shipdate"),
            hours=(F.col("l_orderkey") + F.col("l_linenumber") * 5) % 24,
            amount=F.col("l_extendedprice"),
            refunded=F.col("l_partkey") % 41 == 0,
            file_number=F.col("l_orderkey") % FILES_PER_SERVICE + 1,
            pickup="tpep_pickup_datetime",
            dropoff="tpep_dropoff_datetime",
        )
    )


def green_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as green trips."""
    return table(spark, sf_dir, "orders").select(
        _trip(
            vendor=F.col("o_custkey") % 2 + 1,
            passengers=F.col("o_orderkey") % 7,
            unknown=F.col("o_custkey") % 29 == 0,
            day=F.col("o_orderdate"),
            hours=F.col("o_orderkey") % 24,
            amount=F.col("o_totalprice"),
            refunded=F.col("o_custkey") % 41 == 0,
            file_number=F.col("o_orderkey") % FILES_PER_SERVICE + 1,
            pickup="lpep_pickup_datetime",
            dropoff="lpep_dropoff_datetime",
        )
    )


def raw_trips(spark: SparkSession, sf_dir: str, service: str) -> DataFrame:
    """What the service delivered, as its bronze table would hold it."""
    trips = yellow_trips(spark, sf_dir) if service == "yellow" else green_trips(spark, sf_dir)
    return trips.drop("file_number")


# How the five yellow files differ from each other. File number to
# (vendor column name, its type, passenger_count type, fee column name, its type, fee).
YELLOW_DRIFT = {
    1: ("VendorID", "int", "bigint", "Airport_fee", "double", 1.25),
    2: ("vendorid", "bigint", "double", "airport_fee", "int", None),
    3: ("VENDORID", "bigint", "int", None, None, None),
    4: ("vendorid", "bigint", "bigint", "airport_fee", "float", 1.25),
    5: ("VendorID", "int", "double", "airport_fee", "int", 2),
}


def drifted(trips: DataFrame, number: int) -> DataFrame:
    """The rows of one yellow file, in that file's own schema."""
    vendor, vendor_type, passenger_type, fee, fee_type, fee_value = YELLOW_DRIFT[number]
    columns = [
        F.col("vendorid").cast(vendor_type).alias(vendor),
        F.col("passenger_count").cast(passenger_type).alias("passenger_count"),
        "tpep_pickup_datetime",
        "tpep_dropoff_datetime",
        "total_amount",
    ]
    if fee:
        columns.append(F.lit(fee_value).cast(fee_type).alias(fee))
    return trips.filter(F.col("file_number") == number).select(*columns)


def _side_by_side(spark: SparkSession, files: int) -> AbstractContextManager[None]:
    """Tasks that split trips keep a writer open per file instead of sorting all their rows first."""
    return sql_conf(spark, {"spark.sql.maxConcurrentOutputFileWriters": str(files)})


def _split(spark: SparkSession, trips: DataFrame) -> DataFrame:
    """``trips`` written in parts by their file number; call it within ``_side_by_side``."""
    parts = scratch_dir(spark, "parts")
    trips.write.partitionBy("file_number").parquet(parts)
    return spark.read.parquet(parts)


def write_landing(
    spark: SparkSession, sf_dir: str, root: str, redelivered: bool = False
) -> PipelineSpec:
    """Land every derived trip as monthly files of both services below ``root``.

    The trips are split by file number in one pass over the tables; each file, which has
    a schema of its own, is then written from its own part.
    """
    spec = fleet_spec(root)

    with _side_by_side(spark, FILES_PER_SERVICE):
        yellow, green = in_parallel(
            spark,
            [
                lambda: _split(spark, yellow_trips(spark, sf_dir, redelivered)),
                lambda: _split(spark, green_trips(spark, sf_dir)),
            ],
        )
    jobs = []
    for number in range(1, FILES_PER_SERVICE + 1):
        month = MONTHS[number - 1]
        for service, frame in (
            ("yellow", drifted(yellow, number)),
            ("green", green.filter(F.col("file_number") == number).drop("file_number")),
        ):
            path = spec.file_path(service, month)
            jobs.append(lambda f=frame, p=path: f.write.parquet(p))
    in_parallel(spark, jobs)
    return spec


def by_pickup_month(spark: SparkSession, sf_dir: str, spec: PipelineSpec, service: str) -> DataFrame:
    """All trips of a service, each with the number of the file of its pickup month.

    Pickups at seven come a month late, and those outside the spec's months with the first file.
    """
    trips = yellow_trips(spark, sf_dir) if service == "yellow" else green_trips(spark, sf_dir)
    pickup = F.col(spec.service(service).pickup_col)
    number = F.lit(0)
    for i, (year, month) in enumerate(spec.periods):
        number = F.when((F.year(pickup) == year) & (F.month(pickup) == month), i).otherwise(number)
    late = (F.hour(pickup) == 7).cast("int")
    return trips.withColumn("file_number", F.least(number + late, F.lit(len(spec.periods) - 1)))


def land_months(spark: SparkSession, sf_dir: str, spec: PipelineSpec) -> dict[tuple, DataFrame]:
    """Land every trip in the file of its pickup month; returns what each file holds, by service and month."""
    held = {}
    for service in (s.name for s in spec.services):
        with _side_by_side(spark, len(spec.periods)):
            rows = _split(spark, by_pickup_month(spark, sf_dir, spec, service))
        for i, period in enumerate(spec.periods):
            held[service, period] = rows.filter(F.col("file_number") == i).drop("file_number")
    in_parallel(spark, [lambda k=k: deliver(held[k], spec, *k) for k in held])
    return held


def deliver(rows: DataFrame, spec: PipelineSpec, service: str, period: tuple[int, int]) -> None:
    """Land a file, or land it again."""
    rows.write.mode("overwrite").parquet(spec.file_path(service, period))


def misread(rows: DataFrame) -> DataFrame:
    """A file as it should not have been delivered: vendor 2 is missing, amounts are doubled."""
    return rows.filter("vendorid = 1").withColumn("total_amount", F.col("total_amount") * 2)


_memo: dict[tuple, PipelineSpec] = {}
_memo_lock = threading.RLock()


def _once(spark: SparkSession, sf_dir: str, what: str, make: Callable[[], PipelineSpec]) -> PipelineSpec:
    """``make()`` once per application for as long as the tables' files stay the same."""
    files = [
        row
        for name in ("lineitem", "orders")
        for row in listing(spark, f"{sf_dir}/{name}.parquet", "modificationTime").collect()
    ]
    key = (spark.sparkContext.applicationId, sf_dir, what, tuple(sorted(map(tuple, files))))
    with _memo_lock:
        if key not in _memo:
            _memo[key] = make()
        return _memo[key]


def landed_fleet(spark: SparkSession, sf_dir: str, redelivered: bool = False) -> PipelineSpec:
    """A landing folder for these tables, written once per application."""
    return _once(
        spark,
        sf_dir,
        f"landing, redelivered: {redelivered}",
        lambda: write_landing(spark, sf_dir, scratch_dir(spark, "landing"), redelivered),
    )


def built_fleet(spark: SparkSession, sf_dir: str) -> PipelineSpec:
    """All layers of these tables built from landing files, once per application."""

    def build() -> PipelineSpec:
        spec = own_schemas(spark, landed_fleet(spark, sf_dir, redelivered=True))
        run(spark, spec, scratch_dir(spark, "tables"))
        return spec

    return _once(spark, sf_dir, "layers", build)


def built_by_service(spark: SparkSession, sf_dir: str) -> PipelineSpec:
    """All layers with unified gold by service and month, once per application."""

    def build() -> PipelineSpec:
        landed = landed_fleet(spark, sf_dir, redelivered=True)
        spec = own_schemas(spark, replace(landed, monthly_layout=True, by_service=True))
        run(spark, spec, scratch_dir(spark, "tables"))
        return spec

    return _once(spark, sf_dir, "layers by service", build)


def own_schemas(spark: SparkSession, spec: PipelineSpec) -> PipelineSpec:
    """``in_own_schemas``, dropped with their tables when the interpreter ends."""
    own = in_own_schemas(spec)
    atexit.register(_drop, spark, own)
    return own


def _drop(spark: SparkSession, spec: PipelineSpec) -> None:
    if spark.sparkContext._jsc is None or spark.sparkContext._jsc.sc().isStopped():
        return  # a session's own catalog is gone with it
    for schema in (spec.bronze_schema, spec.silver_schema, spec.gold_schema):
        spark.sql(f"DROP SCHEMA IF EXISTS `{spec.catalog}`.`{schema}` CASCADE")


def folder_drift(spark: SparkSession, sf_dir: str) -> SourceFile:
    """One logical file whose parts drifted: wider numbers, and a column only some have."""
    once = yellow_trips(spark, sf_dir, redelivered=False)
    path = f"{scratch_dir(spark, 'parts')}/yellow/yellow_tripdata_1997-01.parquet"
    variants = {0: ("int", "bigint", None), 1: ("bigint", "double", 0.5), 2: ("int", "int", 1.5)}
    for remainder, (vendor, passengers, tip) in variants.items():
        part = once.filter(F.col("file_number") % 3 == remainder).select(
            F.col("vendorid").cast(vendor).alias("VendorID"),
            F.col("passenger_count").cast(passengers).alias("passenger_count"),
            "total_amount",
            *([F.lit(tip).alias("tip")] if tip else []),
        )
        part.write.mode("append").parquet(path)
    return SourceFile(path)


def type_drift(spark: SparkSession, sf_dir: str) -> list[SourceFile]:
    """Two logical files whose types have nothing numeric in common, or only just."""
    once = yellow_trips(spark, sf_dir, redelivered=False)
    root = f"{scratch_dir(spark, 'types')}/yellow"
    amount, pickup = F.col("total_amount"), F.col("tpep_pickup_datetime")
    variants = [
        (F.col("vendorid").cast("tinyint"), amount.cast("float"), pickup.cast("date"), F.col("passenger_count")),
        (F.col("vendorid").cast("int"), amount.cast("bigint"), pickup, F.col("passenger_count").cast("string")),
    ]
    files = []
    for number, columns in enumerate(variants):
        files.append(SourceFile(f"{root}/yellow_tripdata_1997-0{number + 1}.parquet"))
        names = ("vendorid", "amount", "pickup", "passengers")
        part = once.filter(F.col("file_number") % 2 == number)
        part.select(*[c.alias(n) for c, n in zip(columns, names)]).write.parquet(files[-1].path)
    return files
