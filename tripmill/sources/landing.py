"""The landing gate: which files are expected, which arrived, which are missing."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.sources.footers import footer_facts
from tripmill.spec import PipelineSpec

_SERVICES_SCHEMA = "service string, file_prefix string"
_LISTING_SCHEMA = T.StructType(
    [T.StructField("path", T.StringType()), T.StructField("length", T.LongType())]
)


_LISTING_TASKS_PER_CORE = 4


class NestedFilesError(ValueError):
    """A logical file holds folders: readers would not agree on which parts belong to it."""


class MissingFilesError(RuntimeError):
    """Raised by the gate; ``missing`` holds every ``service/file`` that did not arrive."""

    def __init__(self, missing: list[str], landing_root: str) -> None:
        self.missing = missing
        super().__init__(f"{len(missing)} file(s) missing from {landing_root}: {missing}")


def manifest(spark: SparkSession, spec: PipelineSpec) -> DataFrame:
    """One row per expected file: ``service, month, file, path``."""
    services = spark.createDataFrame(
        [(s.name, s.file_prefix) for s in spec.services], _SERVICES_SCHEMA
    )
    periods = F.array(*[F.struct(F.lit(y).alias("year"), F.lit(m).alias("month")) for y, m in spec.periods])
    root = spec.landing_root.rstrip("/")
    return (
        services.select("*", F.inline(periods))
        .withColumn("file", F.format_string("%s_%d-%02d.parquet", "file_prefix", "year", "month"))
        .select(
            "service",
            "month",
            "file",
            F.concat_ws("/", F.lit(root), "service", "file").alias("path"),
        )
    )


def listing(spark: SparkSession, landing_root: str, *more: str) -> DataFrame:
    """``path, length`` (and ``more`` facts) of every file under the landing folder, without opening any.

    A landing folder that does not exist yet is simply empty. Names that start with ``_`` or
    ``.`` are no data, as for every reader of Spark. The splits of this reader are packed by
    bytes it never opens, so they are merged into a few tasks per core.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    tasks = _LISTING_TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    try:
        return files.load(landing_root).select("path", "length", *more).coalesce(tasks)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _LISTING_SCHEMA)


def arrivals(spark: SparkSession, spec: PipelineSpec, check_footers: bool = False) -> DataFrame:
    """Bytes per logical file: ``service, file, bytes`` (plus ``rows, unreadable``).

    A logical file is one Parquet file or a folder of part files with that name.
    """
    services = "|".join(re.escape(s.name) for s in spec.services)
    # Greedy prefix: the last match counts, so a look-alike inside the root is harmless.
    layout = rf"^.*/({services})/([^/]+_\d{{4}}-\d{{2}}\.parquet)(?:/([^/]+)|(/.*/.*))?$"
    found = listing(spark, spec.landing_root)
    if check_footers:
        found = footer_facts(found)
    nested = F.when(F.regexp_extract("path", layout, 4) != "", F.col("path"))
    sums = [F.sum("length").alias("bytes"), F.min(nested).alias("nested")]
    if check_footers:
        sums += [
            F.sum("num_rows").alias("rows"),
            F.count_if(F.col("num_rows").isNull()).alias("unreadable"),
        ]
    return (
        found.withColumn("service", F.regexp_extract("path", layout, 1))
        .withColumn("file", F.regexp_extract("path", layout, 2))
        .filter(F.col("file") != "")
        .groupBy("service", "file")
        .agg(*sums)
    )


def match_arrivals(
    expected: DataFrame, arrived: DataFrame, on: list[str], unexpected: bool = False
) -> DataFrame:
    """Every expected row with what arrived for it, NULL where nothing did.

    With ``unexpected`` also what arrived without being expected.
    """
    return expected.join(arrived, on, "full" if unexpected else "left")


def landing_status(
    spark: SparkSession, spec: PipelineSpec, check_footers: bool = False
) -> DataFrame:
    """``file_status`` in the order of services and months (a file is named by its year and month)."""
    return file_status(spark, spec, check_footers).orderBy("service", "file")


def file_status(
    spark: SparkSession, spec: PipelineSpec, check_footers: bool = False
) -> DataFrame:
    """``service, month, file, present, size_mb``, one row per expected file.

    Present means "not empty" and not nested: a logical file is a file, or a folder of part
    files and nothing deeper. With ``check_footers`` a file must also have readable
    Parquet footers, and a ``rows`` column is added; a truncated file then counts as missing.
    """
    joined = match_arrivals(
        manifest(spark, spec), arrivals(spark, spec, check_footers), ["service", "file"]
    )
    present = F.coalesce(F.col("bytes") > 0, F.lit(False)) & F.col("nested").isNull()
    if check_footers:
        present = present & F.coalesce(F.col("unreadable") == 0, F.lit(False))
    columns = [
        "service",
        "month",
        "file",
        present.alias("present"),
        F.when(present, F.round(F.col("bytes") / 1e6, 1)).alias("size_mb"),
    ]
    if check_footers:
        columns.append(F.when(present, F.col("rows")).alias("rows"))
    return joined.select(*columns)


@dataclass(frozen=True)
class Landed:
    """What the gate let through: bytes, and rows per service where footers were read."""

    bytes: int
    rows: dict[str, int]


def missing_files(
    spark: SparkSession, spec: PipelineSpec, check_footers: bool = False
) -> DataFrame:
    """``service, file`` of every expected file that is not present."""
    status = file_status(spark, spec, check_footers)
    return status.filter(~F.col("present")).select("service", "file")


def require_landing(
    spark: SparkSession, spec: PipelineSpec, check_footers: bool = False
) -> Landed:
    """Stop with the name of every missing file; return what landed otherwise."""
    expected = manifest(spark, spec)
    joined = match_arrivals(expected, arrivals(spark, spec, check_footers), ["service", "file"])
    absent = F.coalesce(F.col("bytes"), F.lit(0)) == 0
    if check_footers:
        absent = absent | (F.col("unreadable") > 0)
    # One small row per service: at most one name per expected file, and sums.
    found = joined.groupBy("service").agg(
        F.sort_array(
            F.collect_list(F.when(absent, F.concat_ws("/", "service", "file")))
        ).alias("missing"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        F.min("nested").alias("nested"),
        (F.sum("rows") if check_footers else F.lit(None)).alias("rows"),
    ).collect()
    nested = [r.nested for r in found if r.nested]
    if nested:
        raise NestedFilesError(f"part files lie below a folder inside a logical file: {nested}")
    missing = sorted(name for r in found for name in r.missing)
    if missing:
        raise MissingFilesError(missing, spec.landing_root)
    rows = {r.service: r.rows or 0 for r in found} if check_footers else {}
    return Landed(sum(r.bytes for r in found), rows)
