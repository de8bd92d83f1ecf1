"""Type rules: which type a drifting column ends up with, and how it can be read."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

# Numeric types from narrowest to widest, and the type of last resort.
NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double")
FALLBACK_TYPE = "string"

INTEGER_TYPES = ("tinyint", "smallint", "int", "bigint")

# Widenings Spark's Parquet reader does while decoding. Everything not
# listed (bigint to double, any integer to float, anything to string) fails in the reader.
READER_WIDENS = {
    "tinyint": ("smallint", "int", "bigint", "double"),
    "smallint": ("int", "bigint", "double"),
    "int": ("bigint", "double"),
    "float": ("double",),
}

_BY_NAME: dict[str, T.DataType] = {
    "tinyint": T.ByteType(),
    "smallint": T.ShortType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
}


def promote(types: Iterable[str], lossless: bool = False) -> str:
    """The one type for a column seen with ``types`` (``simpleString`` names).

    Untyped (void) sightings do not count. A single type is kept as it is, a mix of
    numeric types becomes the widest of them, any other mix becomes string.

    The widest-type rule puts float above bigint, which rounds large integers. With
    ``lossless`` an integer of 4 bytes or more mixed with float becomes double, which
    holds every int exactly (and every bigint up to 2**53).
    """
    seen = {name for name in types if name != "void"}
    if not seen:
        return FALLBACK_TYPE
    if len(seen) == 1:
        return seen.pop()
    if not seen.issubset(NUMERIC_TYPES):
        return FALLBACK_TYPE
    widest = max(seen, key=NUMERIC_TYPES.index)
    if lossless and widest == "float" and seen & {"int", "bigint"}:
        return "double"
    return widest


def promote_types(types: Iterable[T.DataType], lossless: bool = False) -> T.DataType:
    """``promote`` on DataType objects."""
    by_name = {dt.simpleString(): dt for dt in types}
    name = promote(by_name, lossless)
    return by_name.get(name) or _BY_NAME[name]


def read_type(physical: T.DataType, target: T.DataType) -> T.DataType:
    """The type to ask the Parquet reader for, given what the file holds and what is wanted.

    The target itself where the reader can widen to it. Otherwise integers are read as
    bigint (so that int and bigint files still share one scan) and every other type as
    stored; a cast after the scan does the rest.
    """
    have, want = physical.simpleString(), target.simpleString()
    if have == want or want in READER_WIDENS.get(have, ()):
        return target
    if have in INTEGER_TYPES:
        return T.LongType()
    return physical
