"""Bring frames whose schemas drifted apart to one schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.functions.types import promote_types


class ColumnCaseError(ValueError):
    """Two columns of one frame differ only by case, so lower-casing would merge them."""


def lower_columns(columns: Sequence[str]) -> list[str]:
    """The lower-case names, refusing a frame where two columns would collide."""
    seen: dict[str, str] = {}
    for name in columns:
        first = seen.setdefault(name.lower(), name)
        if first != name:
            raise ColumnCaseError(f"columns {first!r} and {name!r} differ only by case")
    return [name.lower() for name in columns]


def lower_schema(schema: T.StructType) -> T.StructType:
    return T.StructType(
        [
            T.StructField(name, field.dataType)
            for name, field in zip(lower_columns(schema.names), schema.fields)
        ]
    )


def target_schema(
    schemas: Sequence[T.StructType], lossless: bool = False
) -> dict[str, T.DataType]:
    """Column name to final type over all (lower-cased) schemas, in first-seen order."""
    sightings: dict[str, list[T.DataType]] = {}
    for schema in schemas:
        for field in schema.fields:
            sightings.setdefault(field.name, []).append(field.dataType)
    return {name: promote_types(types, lossless) for name, types in sightings.items()}


def conform(df: DataFrame, target: Mapping[str, T.DataType]) -> DataFrame:
    """Exactly the target columns, cast to the target types; missing ones are typed NULLs."""
    have = set(df.columns)

    def column(name: str) -> Column:
        if name not in have:
            return F.lit(None)
        return F.col("`{}`".format(name.replace("`", "``")))

    return df.select([column(name).cast(dt).alias(name) for name, dt in target.items()])


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name of frames with the same columns.

    Paired up like a tournament: each union analyses its inputs again, so a left-deep
    chain over N frames costs N**2. Catalyst flattens both into a single Union.
    """
    if not frames:
        raise ValueError("no input files or frames to union")
    level = list(frames)
    while len(level) > 1:
        paired = [a.unionByName(b) for a, b in zip(level[::2], level[1::2])]
        if len(level) % 2:
            paired.append(level[-1])
        level = paired
    return level[0]


def conform_union(frames: Sequence[DataFrame], lossless: bool = False) -> DataFrame:
    """Lower-case names, promote types per column, fill missing columns, union."""
    lowered = [df.toDF(*lower_columns(df.columns)) for df in frames]
    target = target_schema([df.schema for df in lowered], lossless)
    return union_all([conform(df, target) for df in lowered])
