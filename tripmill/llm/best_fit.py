"""Packing of whole documents into few sequences by exact complements, the rest by best fit.

How many pieces there are of each length is all that packing needs to know: at most one number
per length up to the capacity. From these counts a plan is made on the driver. A length's
gap, what it lacks to a full sequence, is looked up among the single lengths, the sums of two
and the sums of three; a combination that fills the gap is used as often as its lengths are
available. What no combination completes goes, longest first, where it fits
most tightly. The plan then tells each piece by its length and its number among the pieces
of that length where it belongs, so nothing but counts is ever gathered.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tripmill.llm.scratch import written
from tripmill.llm.tokens import by_column, with_end
from tripmill.llm.text import freeing

CAPACITY = 4096
END_ID = 1

#: Lengths up to here are told apart from the number of a piece in one 64-bit word.
MAX_CAPACITY = 1 << 15
NUMBER_BITS = 48

#: Bytes of ids handed on at once.
OUTPUT_BYTES = 4 << 20


class Complements:
    """Combinations of available lengths by their sum.

    ``left`` counts the available pieces of each length, up to the largest sum. Each sum that was asked for keeps one
    combination, or none. Lengths only run out, so a sum without a combination stays so,
    and one whose combination has run out is looked up anew.
    """

    def __init__(self, left: np.ndarray) -> None:
        self.left = left
        self._of = {1: {}, 2: {}, 3: {}}

    def find(self, total: int, parts: int) -> tuple[int, ...] | None:
        """``parts`` available lengths that sum to ``total``; the longest ones there are."""
        known = self._of[parts]
        found = known.get(total, ())
        if found is not None and (not found or not self._available(found)):
            found = known[total] = self._look(total, parts)
        return found

    def _available(self, lengths: tuple[int, ...]) -> bool:
        return all(self.left[length] >= n for length, n in Counter(lengths).items())

    def _look(self, total: int, parts: int) -> tuple[int, ...] | None:
        if total < parts:
            return None
        if parts == 1:
            return (total,) if self.left[total] else None
        if parts == 2:
            small = np.flatnonzero(self.left[: total // 2 + 1])
            fits = self.left[total - small] > (2 * small == total)
            if not fits.any():
                return None
            first = int(small[np.argmax(fits)])
            return (total - first, first)
        for longest in np.flatnonzero(self.left[: total - 1])[::-1].tolist():
            if 3 * longest < total:
                return None
            rest = self.find(total - longest, 2)
            if rest and not self._available((longest, *rest)):
                self.left[longest] -= 1
                rest = self._look(total - longest, 2)
                self.left[longest] += 1
            if rest:
                return (longest, *rest)
        return None


def complete(left: np.ndarray, capacity: int) -> Iterator[tuple[tuple[int, ...], int]]:
    """Combinations of up to four lengths that fill a sequence, and how often each is used.

    Takes them out of ``left``: gaps that one length fills first, then those that two and
    three fill; the longest lengths first each time.
    """
    index = Complements(left)
    for parts in range(4):
        for length in np.flatnonzero(left)[::-1].tolist():
            gap = capacity - length
            while left[length] and (gap if parts else not gap):
                left[length] -= 1
                others = index.find(gap, parts) if parts else ()
                left[length] += 1
                if others is None:
                    break
                chosen = Counter((length, *others))
                times = min(int(left[x]) // n for x, n in chosen.items())
                for x, n in chosen.items():
                    left[x] -= n * times
                yield (length, *others), times


def best_fit(lengths: list[tuple[int, int]], capacity: int) -> list[tuple[tuple, int]]:
    """Sequences for (length, n) in descending order: each piece goes where the least room stays.

    Equal sequences are one entry: its (length, n) pairs, and how many such sequences there are.
    """
    groups: dict[int, list[tuple[tuple, int]]] = {}  # by the room that is left
    rooms = np.zeros(capacity + 1, bool)

    def put(room: int, held: tuple, n: int) -> None:
        groups.setdefault(room, []).append((held, n))
        rooms[room] = True

    for length, n in lengths:
        while n:
            tight = np.flatnonzero(rooms[length:])
            if len(tight):
                room = length + int(tight[0])
                held, same = groups[room].pop()
                rooms[room] = bool(groups[room])
            else:
                room, held, same = capacity, (), -(-n // (capacity // length))
            each = room // length  # having taken one, a sequence is the tightest of all
            full = min(same, n // each)
            n -= full * each
            if full:
                put(room - each * length, (*held, (length, each)), full)
            if full < same and 0 < n < each:
                put(room - n * length, (*held, (length, n)), 1)
                n, full = 0, full + 1
            if held and full < same:
                put(room, held, same - full)
    return [group for found in groups.values() for group in found]


def plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Rows ``length, low, high, each, sequence, offset``, sorted, for counts of pieces by length.

    The pieces of a length numbered from ``low`` to ``high`` lie ``each`` to a sequence, from
    ``offset`` on, in sequences numbered on from ``sequence``. A sequence has at most
    sqrt(2 * capacity) lengths, and there are at most a few kinds of sequence per
    length, so the plan is bounded by the capacity, whatever the number of pieces.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    kinds = [
        (tuple((x, len(list(same))) for x, same in groupby(sorted(lengths))), n)
        for lengths, n in complete(left, capacity)
    ]
    kinds += best_fit([(x, int(left[x])) for x in np.flatnonzero(left)[::-1].tolist()], capacity)
    rows, used, sequence = [], Counter(), 0
    for held, n in kinds:
        offset = 0
        for length, each in held:
            rows.append((length, used[length], used[length] + n * each, each, sequence, offset))
            used[length] += n * each
            offset += length * each
        sequence += n
    return np.array(sorted(rows), np.int64).reshape(-1, 6)


def pieces(
    docs: DataFrame, encoder: Callable[[], Callable], id_col: str, text_col: str, capacity: int, end_id: int
) -> DataFrame:
    """``_id, piece, start, length, ids, part, nth``: a piece is the ``nth`` of its length in task ``part``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, context = encoder(), TaskContext.get()
        part = context.partitionId() if context else 0
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for row, ids, ends in by_column(encode, batch.column(1)):
                ids, ends = with_end(ids, ends, end_id)
                total = np.diff(ends)
                n = -(-total // capacity)
                which = np.repeat(np.arange(len(total)), n)
                piece = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * capacity
                length = np.minimum(total[which] - start, capacity)
                order = np.argsort(length, kind="stable")
                first = np.searchsorted(length[order], length[order])
                nth = np.empty(len(length), np.int64)
                nth[order] = np.arange(len(length)) - first
                nth += seen[length]
                seen += np.bincount(length, minlength=capacity + 1)
                at = 4 * np.r_[ends[:-1][which] + start, ends[-1]]
                held = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(which), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(ids)]
                )
                low = 0
                while low < len(which):
                    high = max(low + 1, int(np.searchsorted(at, at[low] + OUTPUT_BYTES, side="right")) - 1)
                    high, cut = min(high, len(which)), slice(low, high)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(which[cut] + row)),
                            *[pa.array(c[cut], pa.int64()) for c in (piece, start, length)],
                            held.slice(low, high - low).cast(pa.binary()),
                            pa.array(np.full(high - low, part), pa.int32()),
                            pa.array(nth[cut], pa.int64()),
                        ],
                        names=["_id", "piece", "start", "length", "ids", "part", "nth"],
                    )
                    low = high

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"_id {kind}, piece long, start long, length long, ids binary, part int, nth long"
    return docs.select(F.col(id_col).alias("_id"), text_col).mapInArrow(freeing(run), schema)


def pack(
    docs: DataFrame,
    encoder: Callable[[], Callable],
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: the document's id column, ``piece, start, length, ids, sequence_id, offset``.

    ``encoder`` is called once per task and gives the function from text to ids, or one that
    reads whole columns (``tokens.Encoder``). A document is its ids and ``end_id``; only one
    longer than ``capacity`` is cut, into pieces of that length and a last one that may be
    shorter. ``ids`` are the piece's ids as little-endian 32-bit words. A null text is an empty
    one and yields its end id alone. Null ids are ids. Repeated rows are packed once
    each. An empty table gives an empty result. Other columns of ``docs`` are not carried; an
    id column named like a column of the result is refused.

    The tokenised pieces are written once. Which sequence a piece belongs to follows from
    the plan, which is bounded by ``capacity``, from the number of pieces of its length in
    the tasks before its own, and from its own number there; these are fixed by what was written.
    """
    if not 1 <= capacity <= MAX_CAPACITY:
        raise ValueError(f"capacity must be from 1 to {MAX_CAPACITY}")
    if id_col in ("piece", "start", "length", "ids", "sequence_id", "offset"):
        raise ValueError(f"the id column may not be named {id_col}")
    cut = written(pieces(docs, encoder, id_col, text_col, capacity, end_id), "pieces")
    counts = written(cut.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "lengths")
    total = counts.groupBy("length").agg(F.sum("n").alias("n"))  # one row per length up to the capacity
    rows = plan({r.length: r.n for r in total.collect()}, capacity)
    keys = rows[:, 0] << NUMBER_BITS | rows[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("_number").to_numpy()
            found = rows[np.searchsorted(keys, length << NUMBER_BITS | number, side="right") - 1]
            sequence, there = np.divmod(number - found[:, 1], found[:, 3])
            columns = [batch.column(name) for name in names]
            columns += [pa.array(found[:, 4] + sequence), pa.array(found[:, 5] + there * length)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "sequence_id", "offset"])

    # Per length one row per task, so a window over these rows, not over the pieces.
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))
    numbered = cut.join(before, ["length", "part"]).withColumn("_number", F.col("_before") + F.col("nth"))
    names = ["_id", "piece", "start", "length", "ids"]
    schema = T.StructType([cut.schema[name] for name in names])
    schema = schema.add("sequence_id", T.LongType()).add("offset", T.LongType())
    placed = numbered.select(*names, "_number").mapInArrow(freeing(place), schema)
    return placed.withColumnRenamed("_id", id_col)
