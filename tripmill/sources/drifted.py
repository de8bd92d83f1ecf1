"""Read many Parquet files whose schemas drifted, with as few scans as possible."""

from __future__ import annotations

import posixpath
import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.functions.types import read_type
from tripmill.operators.conform import (
    ColumnCaseError,
    conform,
    lower_schema,
    target_schema,
    union_all,
)
from tripmill.sources.footers import footer_facts
from tripmill.sources.landing import NestedFilesError, listing
from tripmill.sources.session import in_parallel

SOURCE_FILE = "_source_file"

# Telling rows of one scan apart by file costs a little per file and row, see `_source_tag`.
_FILES_PER_SCAN = 12
_PLAIN_NAME = re.compile(r"[A-Za-z0-9_.\-]+")


class SchemaGrewError(ValueError):
    """Files do not fit the schema of the rows read before them."""


@dataclass(frozen=True)
class SourceFile:
    """A logical file: a Parquet file, or a folder of part files under that name."""

    path: str

    def __post_init__(self) -> None:
        # Spark reports paths URL-encoded; plain names look the same either way.
        if not _PLAIN_NAME.fullmatch(self.name):
            raise ValueError(f"use only letters, digits, '_', '-' and '.': {self.name!r}")

    @property
    def name(self) -> str:
        return posixpath.basename(self.path.rstrip("/"))


@dataclass(frozen=True)
class FileSchema:
    """A logical file, or those of its parts that share a stored schema (names lower-cased).

    ``parts`` names what the parts have in common where a file has several schemas; ``stored``
    has the columns' names as they are spelled there.
    """

    file: SourceFile
    schema: T.StructType
    parts: str | None = None
    stored: tuple[str, ...] = ()


def file_schemas(
    spark: SparkSession, files: Sequence[SourceFile], footers: str = "auto"
) -> list[FileSchema]:
    """The stored schemas of every logical file, in the order given.

    Every part counts, however many there are. ``"auto"`` has Spark merge the footers of
    each logical file in a job of its own; where parts differ in a type, or in the case of
    a name, ``"executors"`` takes over for that file. ``"executors"`` reads all footers in one job,
    brings back one row per distinct schema of each logical file, and asks Spark for
    the schema of one part per row. It needs storage that Python on the executors can open,
    and fails by path where it cannot. Either way a logical file with folders inside is refused.
    """
    if not files:
        raise ValueError("no input files")
    if footers not in ("auto", "executors"):
        raise ValueError(f"footers must be 'auto' or 'executors': {footers!r}")
    refuse_nested(spark, files)
    if footers == "executors":
        return _schemas_by_fingerprint(spark, files)
    merged = _schemas_of(spark, [f.path for f in files])
    mixed = [f for f, schema in zip(files, merged) if schema is None]
    parts = _schemas_by_fingerprint(spark, mixed) if mixed else []
    return [
        entry
        for file, schema in zip(files, merged)
        for entry in (
            [FileSchema(file, lower_schema(schema), None, tuple(schema.names))]
            if schema is not None
            else [part for part in parts if part.file == file]
        )
    ]


def _schemas_of(spark: SparkSession, paths: Sequence[str]) -> list[T.StructType | None]:
    """The merged schema of each path, as stored; None where its parts cannot be merged."""

    def schema_of(path: str) -> T.StructType | None:
        try:
            merged = spark.read.option("mergeSchema", "true").parquet(path).schema
        except (PySparkException, Py4JJavaError) as error:
            if "[CANNOT_MERGE_SCHEMAS]" not in str(error):
                raise
            return None
        names = [name.lower() for name in merged.fieldNames()]
        return merged if len(set(names)) == len(names) else None

    return in_parallel(spark, [lambda p=path: schema_of(p) for path in paths])


def _parts(spark: SparkSession, files: Sequence[SourceFile]) -> DataFrame:
    """``path, length, name`` of every part of the files."""
    root = _parent(files)
    return (
        listing(spark, root)
        .filter(F.col("length") > 0)
        .withColumn("name", _first_segment_below(F.col("path"), root))
        .filter(F.col("name").isin([f.name for f in files]))
    )


def refuse_nested(spark: SparkSession, files: Sequence[SourceFile]) -> None:
    """Raise ``NestedFilesError`` with the path of a part that lies below a folder in a logical file.

    Spark's reader would leave such parts out, or find them, depending on the rest of the
    folder. Found from the listing alone, no file is opened.
    """
    own_name = F.substring_index("path", "/", -1)
    deeper = _parts(spark, files).filter(
        (F.substring_index("path", "/", -2) != F.concat_ws("/", "name", own_name)) & (own_name != F.col("name"))
    )
    nested = deeper.agg(F.min("path")).first()[0]
    if nested:
        raise NestedFilesError(f"part files lie below a folder inside a logical file: {nested}")


def _fingerprints(spark: SparkSession, files: Sequence[SourceFile]) -> DataFrame:
    """``path, length, num_rows, fingerprint, problem, name`` of every part of the files."""
    return footer_facts(_parts(spark, files))


def _schemas_by_fingerprint(
    spark: SparkSession, files: Sequence[SourceFile]
) -> list[FileSchema]:
    facts = _fingerprints(spark, files)
    groups = (
        facts.groupBy("name", "fingerprint")
        .agg(F.min("path").alias("path"), F.min("problem").alias("problem"))
        .collect()
    )
    groups = sorted(groups, key=lambda g: g.path)
    unreadable = [f"{g.path}: {g.problem}" for g in groups if g.fingerprint is None]
    if unreadable:
        raise ValueError(f"not readable as Parquet: {unreadable}")
    absent = [f.path for f in files if f.name not in {g.name for g in groups}]
    if absent:
        raise ValueError(f"no input files under: {absent}")
    first: dict[str, str] = {}
    for group in groups:
        first.setdefault(group.fingerprint, group.path)
    schemas = dict(zip(first, _schemas_of(spark, list(first.values()))))
    found = []
    for file in files:
        own = [g for g in groups if g.name == file.name]
        for group in own:
            schema = schemas[group.fingerprint]
            if schema is None:
                raise ColumnCaseError(f"columns of {group.path} differ only by case")
            parts = group.fingerprint if len(own) > 1 else None
            found.append(FileSchema(file, lower_schema(schema), parts, tuple(schema.names)))
    return found


def _parent(files: Sequence[SourceFile]) -> str:
    parents = {posixpath.dirname(f.path.rstrip("/")) for f in files}
    if len(parents) != 1:
        raise ValueError(f"files of one table must share a folder: {sorted(parents)}")
    [parent] = parents
    if not _PLAIN_NAME.fullmatch(posixpath.basename(parent)):
        raise ValueError(f"the folder needs a name of letters, digits, '_', '-', '.': {parent!r}")
    return parent


def _first_segment_below(path: Column, root: str) -> Column:
    """The name right under ``root``: the logical file, also for a part file deep inside."""
    marker = f"/{posixpath.basename(root)}/"
    return F.substring_index(F.substring_index(path, marker, -1), "/", 1)


@dataclass
class ScanGroup:
    """Files that one scan can read: for every shared column they ask for the same field."""

    fields: dict[str, T.StructField]
    names: set[str]
    entries: list[FileSchema]

    def accepts(self, entry: FileSchema, wanted: dict[str, T.StructField]) -> bool:
        has_room = entry.file.name in self.names or len(self.names) < _FILES_PER_SCAN
        return has_room and all(
            self.fields.get(name, field) == field for name, field in wanted.items()
        )

    def add(self, entry: FileSchema, wanted: dict[str, T.StructField]) -> None:
        self.fields.update(wanted)
        self.names.add(entry.file.name)
        self.entries.append(entry)

    @property
    def schema(self) -> T.StructType:
        return T.StructType(list(self.fields.values()))


def scan_groups(
    schemas: Sequence[FileSchema], target: dict[str, T.DataType], spelled: bool = False
) -> list[ScanGroup]:
    """Put every file into the first group it fits; a column a file lacks fits anything.

    ``spelled`` asks for the columns by their stored names, for a reader that minds the case.
    """
    groups: list[ScanGroup] = []
    for entry in schemas:
        names = entry.stored if spelled else entry.schema.names
        wanted = {
            field.name: T.StructField(name, read_type(field.dataType, target[field.name]))
            for name, field in zip(names, entry.schema.fields)
            if field.name != SOURCE_FILE
        }
        group = next((g for g in groups if g.accepts(entry, wanted)), None)
        if group is None:
            group = ScanGroup({}, set(), [])
            groups.append(group)
        group.add(entry, wanted)
    return groups


def _paths(
    spark: SparkSession, group: ScanGroup, schemas: Sequence[FileSchema], files: Sequence[SourceFile]
) -> list[str]:
    """What to give the reader: whole logical files where the group holds all their schemas.

    Only of a folder whose parts need different read types are parts named one by one; the
    reader's own file index holds the same list.
    """
    paths, split = [], {}
    for file in {entry.file for entry in group.entries}:
        own = {entry.parts for entry in group.entries if entry.file == file}
        if own == {entry.parts for entry in schemas if entry.file == file}:
            paths.append(file.path)
        else:
            split[file.name] = own
    if split:
        facts = _fingerprints(spark, [f for f in files if f.name in split])
        wanted = [
            (F.col("name") == name) & F.col("fingerprint").isin(sorted(own))
            for name, own in split.items()
        ]
        rows = facts.filter(reduce(or_, wanted)).select("path")
        paths.extend(row.path for row in rows.toLocalIterator())
    return sorted(paths)


def _source_tag(scan: DataFrame, names: set[str], root: str) -> Column:
    """The logical file a row of this scan came from.

    Cutting the name out of a long path costs about as much per row as decoding the row.
    Comparing the path with the few paths that can occur is several times cheaper, and the
    exact spelling of those paths is read off one row. Anything unexpected is still cut.
    """
    if len(names) == 1:
        return F.lit(next(iter(names)))
    path = F.col("_metadata.file_path")
    cut = _first_segment_below(path, root)
    sample = scan.select(path, cut).first()
    if sample is None:
        return cut
    folder = sample[0][: sample[0].rindex(f"/{sample[1]}") + 1]
    tag = None
    # Longest first, should one name begin with another.
    for name in sorted(names, key=lambda n: (-len(n), n)):
        condition = path.startswith(folder + name)
        tag = F.when(condition, name) if tag is None else tag.when(condition, name)
    return tag.otherwise(cut)


def scan_conformed(
    spark: SparkSession,
    files: Sequence[SourceFile],
    lossless: bool = False,
    footers: str = "auto",
    onto: T.StructType | None = None,
) -> DataFrame:
    """All rows of all files under one lower-cased, promoted schema, tagged with their file.

    Columns come in first-seen order over the files as given, with ``_source_file`` right
    after the columns of the first file. The number of scans is the number of groups of
    compatible schemas (of at most a dozen files each), not the number of files. In a session
    that minds the case of names, files of one group also spell their columns alike.

    ``onto`` is the schema these rows have to come out with, that of rows read before; files
    that bring a column it lacks, or need a wider type, raise ``SchemaGrewError``.
    """
    schemas = file_schemas(spark, files, footers)
    root = _parent(files)
    tag = T.StructField(SOURCE_FILE, T.StringType())
    found = [
        T.StructType([f for f in s.schema.fields if f.name != SOURCE_FILE] + [tag]) for s in schemas
    ]
    target = target_schema([*([onto] if onto else []), *found], lossless)
    if onto:
        grown = [n for n, t in target.items() if n not in onto.names or onto[n].dataType != t]
        if grown:
            raise SchemaGrewError(f"new or wider columns, build in full: {grown}")
    frames = []
    spelled = spark.conf.get("spark.sql.caseSensitive") == "true"
    for group in scan_groups(schemas, target, spelled):
        scan = spark.read.schema(group.schema).parquet(*_paths(spark, group, schemas, files))
        source = _source_tag(scan, group.names, root)
        tagged = scan.withColumn(SOURCE_FILE, source).toDF(*group.fields, SOURCE_FILE)
        frames.append(conform(tagged, target))
    return union_all(frames)


def rows_per_file(spark: SparkSession, files: Sequence[SourceFile]) -> DataFrame:
    """``file, rows_in_file`` of every logical file that holds rows.

    No data column is read: the reader takes the row counts from the footers. A logical file with
    folders inside is refused.
    """
    refuse_nested(spark, files)
    return _rows_per_file(spark, files)


def _rows_per_file(spark: SparkSession, files: Sequence[SourceFile]) -> DataFrame:
    return (
        spark.read.schema("nothing int")
        .parquet(*[f.path for f in files])
        .groupBy(F.col("_metadata.file_path").alias("path"))
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(_first_segment_below(F.col("path"), _parent(files)).alias("file"))
        .agg(F.sum("n").alias("rows_in_file"))
    )


def drift_report(
    spark: SparkSession,
    files: Sequence[SourceFile],
    lossless: bool = False,
    footers: str = "auto",
) -> DataFrame:
    """What each column looked like over the files and what became of it.

    ``column_name, files, rows, types, target_type, fell_back``: how many files carry the
    column, how many rows those files hold, the distinct stored types, the promoted type,
    and whether a type mix had to fall back to string.
    """
    schemas = file_schemas(spark, files, footers)
    target = target_schema([s.schema for s in schemas], lossless)
    sightings = spark.createDataFrame(
        [
            (
                s.file.name,
                field.name,
                field.dataType.simpleString(),
                target[field.name].simpleString(),
            )
            for s in schemas
            for field in s.schema.fields
        ],
        "file string, column_name string, type string, target_type string",
    )
    counts = _rows_per_file(spark, files)
    per_file = sightings.groupBy("file", "column_name", "target_type").agg(
        F.collect_set("type").alias("types")
    )
    types = F.array_sort(F.array_distinct(F.flatten(F.collect_list("types"))))
    return (
        per_file.join(counts, "file", "left")
        .groupBy("column_name", "target_type")
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.sum(F.coalesce("rows_in_file", F.lit(0))).alias("rows"),
            types.alias("types"),
        )
        .select(
            "column_name",
            "files",
            "rows",
            F.array_join("types", ", ").alias("types"),
            "target_type",
            (
                (F.size(F.array_remove("types", "void")) > 1)
                & (F.col("target_type") == "string")
            ).alias("fell_back"),
        )
        .orderBy("column_name")
    )
