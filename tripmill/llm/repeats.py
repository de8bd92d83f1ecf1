"""Windows of text that repeat anywhere in a table, found shard by shard.

Documents are cut into fragments by anchors (see ``anchors``). Fragments whose anchor is
alone repeat nothing. Equal fragments are settled by their anchors and a 64-bit hash. What is left, different
fragments around one anchor, is dealt into shards of bounded size, and a search inside
each shard finds the windows they share.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.anchors import fragments
from tripmill.llm.groups import by_group
from tripmill.llm.marks import apart
from tripmill.llm.scratch import written
from tripmill.llm.text import Powers, byte_values, freeing, mix, slices, word_spans

#: Different fragments around one anchor up to which they are searched together, which is what
#: a task can hold; the windows of a more frequent anchor are told apart by their own hashes.
HOT = 1 << 14

#: Equal fragments are hot from so many rows on, or from a share of 1 in ``HOT_KEYS`` of all rows, so
#: there are at most ``HOT_KEYS`` hot ones: few enough to be sent to every task.
HOT_ROWS = 1000
HOT_KEYS = 100_000


@dataclass(frozen=True)
class Shard:
    """Fragments in the order of their documents: bytes, first symbol's number, anchor's byte."""

    texts: list[bytes]
    starts: np.ndarray
    at: np.ndarray


#: From a shard to (fragment, first symbol, end) of the windows that go, counted in the fragment.
Search = Callable[[Shard], list[tuple[int, int, int]]]


@dataclass(frozen=True)
class Rule:
    """What a window is, and which of equal windows go: all, or all but the first."""

    words: bool
    window: int
    gram: int
    first_stays: bool
    shard_symbols: int
    search: Search

    def symbols(self, data: np.ndarray, offsets: np.ndarray, powers: Powers) -> tuple:
        """Values, offsets in values, and first and last byte of each value."""
        if not self.words:
            return byte_values()[data], offsets, None, None
        starts, ends, first = word_spans(data, offsets)
        values = powers.ranges(mix(data.astype(np.uint64) + np.uint64(1)), starts, ends)
        return values, first, starts, ends


def keyed(docs: DataFrame, id_col: str, text_col: str, carry: Sequence[str] = ()) -> DataFrame:
    """``_id, _hash, _text, carried``: rows that repeat an id are told apart by their texts."""
    return docs.select(
        F.col(id_col).alias("_id"),
        F.xxhash64(F.col(text_col)).alias("_hash"),
        F.col(text_col).alias("_text"),
        *([F.struct(*[F.col(c) for c in carry]).alias("carried")] if carry else []),
    )


def _cut(rows: DataFrame, rule: Rule) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_powers, powers = Powers(), Powers(1)
        for batch in batches:
            for row, data, offsets in slices(batch.column(2)):
                values, first, _, _ = rule.symbols(data, offsets, word_powers)
                found = fragments(values, first, rule.window, rule.gram, powers)
                which = pa.array(found.text + row)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(which),
                        batch.column(1).take(which),
                        pa.array((found.start - first[found.text]).astype(np.int32)),
                        pa.array((found.end - found.start).astype(np.int32)),
                        pa.array((found.anchor_at - found.start).astype(np.int32)),
                        pa.array(found.anchor.view(np.int64)),
                        pa.array(found.content.view(np.int64)),
                    ],
                    names=["_id", "_hash", "start", "length", "at", "anchor", "content"],
                )

    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(
        freeing(run), f"_id {kind}, _hash long, start int, length int, at int, anchor long, content long"
    )


def _fetch(rows: DataFrame, wanted: DataFrame, rule: Rule) -> DataFrame:
    """The bytes of ``wanted`` fragments; of those with a hot anchor each window on its own."""
    per_text = wanted.groupBy("_id", "_hash").agg(
        F.array_sort(F.collect_list(F.struct("start", "length", "at", "anchor", "hot"))).alias("_parts")
    )
    side = written(per_text.select(F.col("_id").alias("_i"), F.col("_hash").alias("_h"), "_parts"), "parts")
    some, _ = apart(rows, side.select(F.xxhash64("_i", "_h").alias("mark")), F.xxhash64("_id", "_hash"))
    joined = some.join(side, _same_text())

    def rows_of(batch, where, start, length, at, anchor, content, text) -> pa.RecordBatch:  # noqa: ANN001
        which = pa.array(where)
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(which), batch.column(1).take(which)]
            + [pa.array(c, pa.int32()) for c in (start, length, at)]
            + [pa.array(anchor, pa.int64()), pa.array(content, pa.int64()), pa.array(text, pa.binary())],
            names=["_id", "_hash", "start", "length", "at", "anchor", "content", "text"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_powers, powers, other = Powers(), Powers(1), Powers(2)
        for batch in batches:
            parts = batch.column(3)
            for row, data, offsets in slices(batch.column(2)):
                values, first, begin, end = rule.symbols(data, offsets, word_powers)
                whole, texts, windows = [], [], []
                for i in range(len(offsets) - 1):
                    for part in parts[row + i].as_py():
                        a = int(first[i]) + part["start"]
                        b = a + part["length"]
                        if part["hot"]:
                            own, start = values[a:b], np.arange(part["length"] - rule.window + 1)
                            one = powers.ranges(own, start, start + rule.window).view(np.int64)
                            two = other.ranges(own, start, start + rule.window).view(np.int64)
                            windows.append((np.full(len(start), row + i), start + part["start"], one, two))
                        else:
                            whole.append((row + i, part["start"], part["length"], part["at"], part["anchor"]))
                            text = data[begin[a] : end[b - 1]] if rule.words else data[a:b]
                            texts.append(text.tobytes())
                if whole:
                    where, start, length, at, anchor = map(np.array, zip(*whole))
                    yield rows_of(batch, where, start, length, at, anchor, np.zeros_like(anchor), texts)
                if windows:
                    where, start, one, two = map(np.concatenate, zip(*windows))
                    length = np.full(len(start), rule.window)
                    nothing = pa.nulls(len(start), pa.binary())
                    yield rows_of(batch, where, start, length, np.zeros_like(start), one, two, nothing)

    kind = rows.schema["_id"].dataType.simpleString()
    return joined.select("_id", "_hash", "_text", "_parts").mapInArrow(
        freeing(run),
        f"_id {kind}, _hash long, start int, length int, at int, anchor long, content long, text binary",
    )


def _same_text() -> Column:
    return F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_hash") == F.col("_h"))


def _search(found: DataFrame, shards: int, rule: Rule) -> DataFrame:
    def run(table: pa.Table) -> pa.RecordBatch | None:
        shard = table["shard"].to_numpy()
        edges = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1], True])
        rows, starts, ends = [], [], []
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            part = table.slice(a, b - a)
            first = part["start"].to_numpy()
            for fragment, start, end in rule.search(Shard(part["text"].to_pylist(), first, part["at"].to_numpy())):
                rows.append(a + fragment)
                starts.append(int(first[fragment]) + start)
                ends.append(int(first[fragment]) + end)
        if rows:
            whole = table.select(["_id", "_hash"]).combine_chunks().take(pa.array(rows))
            return pa.RecordBatch.from_arrays(
                [c.combine_chunks() for c in whole.columns] + [pa.array(starts, pa.int32()), pa.array(ends, pa.int32())],
                names=["_id", "_hash", "start", "end"],
            )

    dealt = found.withColumn("shard", F.pmod("anchor", F.lit(shards)))
    kind = found.schema["_id"].dataType.simpleString()
    return by_group(
        dealt.select("shard", "_id", "_hash", "start", "at", "text"),
        ["shard"],
        run,
        f"_id {kind}, _hash long, start int, end int",
        order=("_id", "_hash", "start"),
    )


def _settled(pieces: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """Different pieces, each with its first place; and the spans that equal pieces settle."""
    place = F.struct("_id", "_hash", "start")
    different = pieces.groupBy("anchor", "content").agg(
        F.min(F.struct("_id", "_hash", "start", "length", "at")).alias("first"), F.count(F.lit(1)).alias("_n")
    )
    different = written(different, "different")
    repeated = different.filter(F.col("_n") > 1).select(
        "anchor", "content", "_n", F.struct("first._id", "first._hash", "first.start").alias("_first")
    )
    most = max(HOT_ROWS, pieces.count() // HOT_KEYS)
    same = ["anchor", "content"]
    few = repeated.filter(F.col("_n") <= most).drop("_n")
    hot = repeated.filter(F.col("_n") > most).drop("_n")
    # A hot fragment stays where it is; shuffled, all its rows would be one task's.
    rest = pieces.join(F.broadcast(hot.select(*same)), same, "left_anti")
    settled = pieces.join(F.broadcast(hot), same).unionByName(rest.join(few, same))
    if rule.first_stays:
        settled = settled.filter(place != F.col("_first"))
    return different, settled.select("_id", "_hash", "start", (F.col("start") + F.col("length")).alias("end"))


def repeated_spans(rows: DataFrame, rule: Rule) -> DataFrame:
    """``_id, _hash, spans``: of each text the (start, end) of symbols that go, unmerged."""
    rows = rows.select("_id", "_hash", "_text")
    if _repeats(rows):  # equal rows are one document
        rows = rows.dropDuplicates(["_id", "_hash"])
    pieces = written(_cut(rows, rule), "fragments")
    often = pieces.groupBy("anchor").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    # Written first: a join of two tables is one whose hot anchors Spark can split.
    often = written(often.select("anchor"), "anchors")
    pieces = written(pieces.join(often, "anchor", "left_semi"), "repeated")
    different, equal = _settled(pieces, rule)
    open_anchors = different.groupBy("anchor").agg(F.count(F.lit(1)).alias("_k")).filter(F.col("_k") > 1)
    wanted = different.join(open_anchors, "anchor").select(
        "first.*", "anchor", (F.col("_k") > HOT).alias("hot")
    )
    found = written(_fetch(rows, wanted, rule), "texts")
    cold = found.filter(F.col("text").isNotNull())
    symbols = cold.agg(F.sum("length")).first()[0] or 0
    shared = _search(cold, -(-symbols // rule.shard_symbols) or 1, rule)
    _, hot = _settled(found.filter(F.col("text").isNull()).drop("text"), rule)
    spans = equal.unionByName(shared).unionByName(hot)
    return written(
        spans.groupBy("_id", "_hash").agg(F.collect_set(F.struct("start", "end")).alias("spans")), "spans"
    )


def _repeats(rows: DataFrame) -> bool:
    """Whether any row's id and text occur twice."""
    keys = rows.groupBy("_id", "_hash").count()
    return not keys.filter(F.col("count") > 1).isEmpty()


def with_spans(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """``rows`` with ``spans`` (null where nothing goes).

    Only texts that may have spans are shuffled; the rows are read a second time for the others.
    """
    side = spans.select(F.col("_id").alias("_i"), F.col("_hash").alias("_h"), "spans")
    some, others = apart(rows, side.select(F.xxhash64("_i", "_h").alias("mark")), F.xxhash64("_id", "_hash"))
    cut = some.join(side, _same_text(), "left").select(*rows.columns, "spans")
    return cut.unionByName(others.withColumn("spans", F.lit(None).cast(side.schema["spans"].dataType)))


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Spans in order, those that touch or overlap made one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in spans or ()):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out
