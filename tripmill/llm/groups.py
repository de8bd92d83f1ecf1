"""Whole groups of rows, one bounded batch after another, inside a task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tripmill.llm.text import freeing


def by_group(
    frame: DataFrame,
    keys: list[str],
    run: Callable[[pa.Table], pa.RecordBatch | None],
    schema: str,
    order: tuple[str, ...] = (),
) -> DataFrame:
    """``run`` over tables of whole groups: rows with equal ``keys`` come in one table.

    The rows are dealt out and sorted by ``keys``, then ``order``, so a task holds the groups of about one
    Arrow batch, and its largest group. Callers keep groups small.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def key(batch: pa.RecordBatch, row: int) -> list:
            return [batch.column(name)[row].as_py() for name in keys]

        for batch in batches:
            if not batch.num_rows:
                continue
            last = key(batch, batch.num_rows - 1)
            low, high = 0, batch.num_rows - 1
            while low < high:  # the first row of the last group
                middle = (low + high) // 2
                low, high = (low, middle) if key(batch, middle) == last else (middle + 1, high)
            if held and (low or key(held[0], 0) != last):
                if low:
                    held.append(batch.slice(0, low))
                if (out := run(pa.Table.from_batches(held))) is not None:
                    yield out
                held = []
            elif low:
                if (out := run(pa.Table.from_batches([batch.slice(0, low)]))) is not None:
                    yield out
            held.append(batch.slice(low))
        if held and (out := run(pa.Table.from_batches(held))) is not None:
            yield out

    parts = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return frame.repartition(parts, *keys).sortWithinPartitions(*keys, *order).mapInArrow(freeing(whole), schema)
