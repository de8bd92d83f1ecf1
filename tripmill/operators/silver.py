"""Silver: one typed schema for every service, one time scope, no exact duplicates."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions.dates import in_ranges
from tripmill.spec import PipelineSpec

SERVICE_TYPE = "service_type"
COPIES = "copies"

# The columns silver keeps besides the service tag, and their types.
TRIP_COLUMNS = {
    "vendorid": "int",
    "passenger_count": "int",
    "pickup_datetime": "timestamp_ntz",
    "dropoff_datetime": "timestamp_ntz",
    "total_amount": "double",
}
SILVER_COLUMNS = (SERVICE_TYPE, *TRIP_COLUMNS)


#: What is said about a row that a value keeps out of silver.
REASON = "reason"


@dataclass(frozen=True)
class SilverAudit:
    """Where every bronze row of a service went."""

    service: str
    raw: int
    null_pickup: int
    in_scope: int
    kept: int
    rejected: int = 0

    @property
    def out_of_scope(self) -> int:
        """Rows that fit but lie outside the scope, NULL pickups included."""
        return self.raw - self.rejected - self.in_scope

    @property
    def duplicates(self) -> int:
        return self.in_scope - self.kept


def _present(
    bronze: DataFrame, spec: PipelineSpec, service: str, keep: Sequence[str] = ()
) -> tuple[DataFrame, dict[str, Column]]:
    """The columns silver needs, as stored but under their common names, and for each column that
    may hold values that do not fit whether this one does not.
    """
    described = spec.service(service)
    source = {
        "pickup_datetime": described.pickup_col.lower(),
        "dropoff_datetime": described.dropoff_col.lower(),
    }
    # One select resolves the names once, whatever their case.
    present = bronze.select([F.col(f"`{source.get(n, n)}`").alias(n) for n in TRIP_COLUMNS] + list(keep))
    stored = dict(present.dtypes)
    bad = {
        name: F.col(name).isNotNull() & F.col(name).try_cast(data_type).isNull()
        for name, data_type in TRIP_COLUMNS.items()
        if stored[name] != data_type
    }
    return present, bad


def _any(conditions: dict[str, Column]) -> Column:
    return reduce(or_, conditions.values(), F.lit(False))


def typed_trips(
    bronze: DataFrame, spec: PipelineSpec, service: str, keep: Sequence[str] = ()
) -> DataFrame:
    """Common names and types, and the columns in ``keep``; without the service tag.

    Every row is here, in scope or not, but for those that ``rejected_rows`` holds where
    ``on_bad_cast`` is ``"route"``.
    """
    present, bad = _present(bronze, spec, service, keep)
    if bad and spec.on_bad_cast == "route":
        present = present.filter(~_any(bad))
    return present.select(
        [
            _checked(name, data_type, spec.on_bad_cast) if name in bad else F.col(name)
            for name, data_type in TRIP_COLUMNS.items()
        ]
        + list(keep)
    )


def _checked(name: str, data_type: str, on_bad_cast: str) -> Column:
    """``name`` cast so that a value that does not fit has one outcome, ANSI mode or not."""
    cast = F.col(name).try_cast(data_type)
    if on_bad_cast == "fail":
        message = F.concat(
            F.lit(f"{name} does not fit {data_type}: "), F.col(name).cast("string")
        )
        bad = cast.isNull() & F.col(name).isNotNull()
        cast = F.when(bad, F.raise_error(message).cast(data_type)).otherwise(cast)
    return cast.alias(name)


def rejected_rows(
    bronze: DataFrame, spec: PipelineSpec, service: str, keep: Sequence[str] = ()
) -> DataFrame:
    """Every row with a value that does not fit its silver type, whatever its pickup time.

    Silver's columns as text, as they were stored, the columns in ``keep``, and ``reason``, which
    names each column that does not fit. Copies stay. Columns that are stored in their silver type
    fit by definition, so nothing is read where all of them are.
    """
    present, bad = _present(bronze, spec, service, keep)
    reasons = [F.when(own, F.lit(f"{name} does not fit {TRIP_COLUMNS[name]}")) for name, own in bad.items()]
    found = present.filter(_any(bad)).select(
        [F.col(name).cast("string").alias(name) for name in TRIP_COLUMNS]
        + list(keep)
        + [F.concat_ws("; ", *reasons).alias(REASON)]
    )
    return tag_service(found, service)


def arrival_metrics(bronze: DataFrame, spec: PipelineSpec, service: str) -> dict[str, Column]:
    """What a writer of bronze rows counts for the audit: ``rows, pickups, rejected``.

    ``pickups`` are usable pickup times, ``rejected`` rows that silver will not take. Both are
    expressions over the bronze columns themselves.
    """
    described = spec.service(service)
    source = {"pickup_datetime": described.pickup_col, "dropoff_datetime": described.dropoff_col}
    stored = {name.lower(): data_type for name, data_type in bronze.dtypes}
    usable, rejected = None, F.lit(False)
    for name, data_type in TRIP_COLUMNS.items():
        own = source.get(name, name).lower()
        cast = F.col(f"`{own}`").try_cast(data_type)
        if spec.on_bad_cast == "route" and stored[own] != data_type:
            rejected = rejected | (F.col(f"`{own}`").isNotNull() & cast.isNull())
        if name == "pickup_datetime":
            usable = cast.isNotNull()
    return {
        "rows": F.count(F.lit(1)),
        "pickups": F.count_if(usable & ~rejected),
        "rejected": F.count_if(rejected),
    }


def in_scope(trips: DataFrame, spec: PipelineSpec) -> DataFrame:
    """Pickups inside the scope. A NULL pickup compares to NULL and is dropped too."""
    return trips.filter(in_ranges(F.col("pickup_datetime"), spec.scope_ranges))


def distinct_rows(df: DataFrame) -> DataFrame:
    """One of each set of rows that are equal in every column (NULL equals NULL).

    Spark collapses copies inside each task before the shuffle, so a row that makes up a
    third of the input still sends one copy per task.
    """
    return df.dropDuplicates()


def counted_rows(df: DataFrame) -> DataFrame:
    """``distinct_rows`` that also says how many rows stood behind each one (``copies``)."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(COPIES))


def tag_service(df: DataFrame, service: str) -> DataFrame:
    return df.select(F.lit(service).alias(SERVICE_TYPE), "*")


def silver(bronze: DataFrame, spec: PipelineSpec, service: str) -> DataFrame:
    """Bronze rows of one service as silver rows.

    The constant service tag is added after the dedupe, to keep it out of the shuffle.
    """
    return tag_service(
        distinct_rows(in_scope(typed_trips(bronze, spec, service), spec)), service
    )


def silver_counted(bronze: DataFrame, spec: PipelineSpec, service: str) -> DataFrame:
    """``silver`` with the ``copies`` column, from which a writer can account for every row."""
    return tag_service(
        counted_rows(in_scope(typed_trips(bronze, spec, service), spec)), service
    )


def silver_audit(bronze: DataFrame, spec: PipelineSpec, service: str) -> DataFrame:
    """One row: ``service_type, raw, null_pickup, in_scope, kept, out_of_scope, duplicates``.

    Where ``on_bad_cast`` is ``"route"`` also ``rejected``. Two scans: one of the pickup column
    (and of those that may not fit) for what came in, one that is pruned to the
    scope for what stays. A layered build gets the same numbers while writing instead.
    """
    counted = arrival_metrics(bronze, spec, service)
    came_in = bronze.agg(*[column.alias(name) for name, column in counted.items()]).select(
        F.col("rows").alias("raw"),
        (F.col("rows") - F.col("pickups") - F.col("rejected")).alias("null_pickup"),
        "rejected",
    )
    stays = counted_rows(in_scope(typed_trips(bronze, spec, service), spec)).agg(
        F.sum(COPIES).alias("in_scope"), F.count(F.lit(1)).alias("kept")
    )
    # Two one-row results; lining them up by name and summing needs no join.
    counts = came_in.unionByName(stays, allowMissingColumns=True).agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in _COUNTS]
    )
    return _balanced(tag_service(counts, service), spec)


_COUNTS = ("raw", "null_pickup", "in_scope", "kept", "rejected")


def _balanced(counts: DataFrame, spec: PipelineSpec) -> DataFrame:
    """``counts`` with what follows from them; without ``rejected`` where nothing can be."""
    added = counts.select(
        "*",
        (F.col("raw") - F.col("rejected") - F.col("in_scope")).alias("out_of_scope"),
        (F.col("in_scope") - F.col("kept")).alias("duplicates"),
    )
    return added if spec.on_bad_cast == "route" else added.drop("rejected")


def file_audit(
    bronze: DataFrame, spec: PipelineSpec, service: str, file_col: str = "_source_file"
) -> DataFrame:
    """``silver_audit`` for each landed file: one row per file, with its name in ``file_col``.

    A row that several files hold is kept for the file of the earliest month and a duplicate in
    the others, so the files' counts add up to those of ``silver_audit``. Files whose names do
    not end in ``yyyy-MM.parquet`` are counted together, under NULL and as the latest.

    Files are told apart by the number of their month, so the dedupe stays a hash aggregate over fixed-width
    values with one shuffle on the row, like silver's own; the second one moves a row per file and task.
    """
    year, month = (F.substring(file_col, at, n).try_cast("int") for at, n in ((-15, 4), (-10, 2)))
    number = F.coalesce(year * 12 + month - 1, F.lit(_NO_MONTH))
    numbered = bronze.withColumn(_FILE, number)
    counted = arrival_metrics(bronze, spec, service)
    came_in = numbered.groupBy(_FILE).agg(*[column.alias(name) for name, column in counted.items()]).select(
        _FILE,
        F.col("rows").alias("raw"),
        (F.col("rows") - F.col("pickups") - F.col("rejected")).alias("null_pickup"),
        "rejected",
    )
    scoped = in_scope(typed_trips(numbered, spec, service, keep=[_FILE]), spec)
    inside = scoped.groupBy(_FILE).agg(F.count(F.lit(1)).alias("in_scope"))
    first = scoped.groupBy(*TRIP_COLUMNS).agg(F.min(_FILE).alias(_FILE))
    kept = first.groupBy(_FILE).agg(F.count(F.lit(1)).alias("kept"))
    parts = came_in.unionByName(inside, allowMissingColumns=True).unionByName(kept, allowMissingColumns=True)
    counts = parts.groupBy(_FILE).agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in _COUNTS])
    prefix = spec.service(service).file_prefix
    named = F.format_string(f"{prefix}_%04d-%02d.parquet", F.floor(F.col(_FILE) / 12), F.col(_FILE) % 12 + 1)
    counts = counts.select(F.when(F.col(_FILE) != _NO_MONTH, named).alias(file_col), *_COUNTS)
    return _balanced(tag_service(counts, service), spec)


_FILE, _NO_MONTH = "_file_month", (1 << 31) - 1
