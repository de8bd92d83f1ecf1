"""Packing of tokenised documents into sequences by minimum bin slack.

Every document is cut into whole sequences and one shorter rest. The rests of a task are
packed sequence by sequence: the longest one goes in first, then a subset-sum over the
multiset of remaining lengths, held as a bitset, finds the filling closest to capacity.
Where that leaves room, the longest rest still held is cut to fill it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tripmill.llm.tokens import Encoder, by_column, with_end
from tripmill.llm.text import freeing

CAPACITY = 2048
END_ID = 1

#: Rests kept at hand before sequences are closed; more choice, less padding, more memory.
BUFFER = 4096

#: Bytes of ids handed on at once.
OUTPUT_BYTES = 4 << 20


def byte_bpe(path: str) -> Encoder:
    """An encoder with the ids of the byte-level tokenizer file at ``path``, for a worker with little memory."""
    return Encoder(path, slice_bytes=1 << 20)


def fill(lengths: dict[int, int], capacity: int) -> list[int]:
    """Lengths, taken out of the multiset ``lengths``, whose sum is closest to ``capacity``.

    The longest one is always taken. Bit s of ``reach`` says that some choice sums to s;
    the states before each step are kept, and walking them back gives the choice.
    """
    order = sorted(lengths, reverse=True)
    first = order[0]
    room = capacity - first
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in order:
        left = lengths[length] - (length == first)
        for _ in range(min(left, room // length)):
            wider = (reach | reach << length) & mask
            if wider == reach:
                break
            steps.append((length, reach))
            reach = wider
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    chosen = [first]
    for length, before in reversed(steps):
        if not before >> total & 1:
            chosen.append(length)
            total -= length
    for length in chosen:
        lengths[length] -= 1
        if not lengths[length]:
            del lengths[length]
    return chosen


def pack(
    docs: DataFrame,
    encoder: Callable[[], Callable[[str], list[int]]],
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    buffer: int = BUFFER,
) -> DataFrame:
    """One row per piece: the document's id column, ``start, length, ids, doc_tokens,
    sequence_id, offset``.

    ``encoder`` is called once per task and gives the function from text to ids, or one that
    reads whole columns (``tokens.Encoder``). ``ids`` are
    the piece's ids as little-endian 32-bit words. A null text is an empty one and yields
    its end id alone; so does an empty text. Repeated rows are packed once each. An empty
    table gives an empty result. Other columns of ``docs`` are not carried.

    No shuffle and no group: a task packs what it reads, holds at most ``buffer`` rests,
    and leaves one sequence short at most, its last. Sequence ids are the task's
    number and a counter, so a task that runs again yields the same rows.
    """
    id_field = docs.schema[id_col]
    out = T.StructType(
        [
            T.StructField(id_col, id_field.dataType),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        context = TaskContext.get()
        next_id = (context.partitionId() if context else 0) << 40
        rests: dict[int, list[tuple]] = {}
        counts: dict[int, int] = {}
        held = 0

        def close_one() -> None:
            nonlocal next_id, held
            at = 0
            for length in fill(counts, capacity):
                doc, start, ids, total = rests[length].pop()
                rows.append((doc, start, length, ids, total, next_id, at))
                at += length
                held -= 1
            room = capacity - at
            if room and counts:  # whatever is left is longer than the room
                longest = max(counts)
                doc, start, ids, total = rests[longest].pop()
                rows.append((doc, start, room, ids[: 4 * room], total, next_id, at))
                counts[longest] -= 1
                if not counts[longest]:
                    del counts[longest]
                hold(longest - room, (doc, start + room, ids[4 * room :], total))
            next_id += 1

        def hold(length: int, rest: tuple) -> None:
            rests.setdefault(length, []).append(rest)
            counts[length] = counts.get(length, 0) + 1

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [[] for _ in names]
            rows.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(columns, types)], names=names
            )

        names = [f.name for f in out]
        rows: list[tuple] = []
        types = None
        for batch in batches:
            types = types or [batch.column(0).type, *[pa.int64()] * 2, pa.binary(), *[pa.int64()] * 3]
            size = 0
            docs_of = batch.column(0).to_pylist()
            for row, ids, ends in by_column(encode, batch.column(1)):
                ids, ends = with_end(ids, ends, end_id)
                for doc, low, high in zip(docs_of[row:], ends[:-1].tolist(), ends[1:].tolist()):
                    total = high - low
                    rest = total % capacity
                    for start in range(0, total - rest, capacity):
                        part = ids[4 * (low + start) : 4 * (low + start + capacity)]
                        rows.append((doc, start, capacity, part, total, next_id, 0))
                        next_id += 1
                    if rest:
                        hold(rest, (doc, total - rest, ids[4 * (high - rest) : 4 * high], total))
                        held += 1
                    if held >= buffer:
                        while held > buffer // 2:
                            close_one()
                    size += 4 * total
                    if size > OUTPUT_BYTES:
                        size = 0
                        yield flush()
            yield flush()
        if types:
            while held:
                close_one()
            yield flush()

    return docs.select(id_col, text_col).mapInArrow(freeing(run), out)
