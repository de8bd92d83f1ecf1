"""Exact top-k inner-product search over a vector-approximation file.

Vectors are kept in blocks, each with a coarse cell per component next to the exact numbers.
The cells of a block bound every score of a query from both sides; exact vectors are then
read from the highest upper bound down, until no bound reaches the k-th score found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 4096
QUERY_BLOCK = 512

#: Cells per component.
CELLS = 32

#: Exact vectors read at a time.
_READ = 64


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component; null if any is null or not finite."""
    double = F.transform(vector, lambda x: x.cast("double"))
    usable = F.forall(double, lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return F.when(usable, F.transform(double, lambda x: F.floor(x * scale).cast("long")))


def blocks(vectors: DataFrame, size: int) -> DataFrame:
    """``vectors`` (``_id, _vector``) in blocks of one dimension: ``dim, ids, exact, low, step, cells``.

    ``cells`` says in which cell above ``low`` each component lies; ``step`` is the cell's width.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, tuple[list, list]] = {}

        def close(dim: int) -> pa.RecordBatch:
            ids, rows = waiting.pop(dim)
            exact = np.concatenate(rows).reshape(len(ids), dim)
            low = int(exact.min(initial=0))
            step = -(-(int(exact.max(initial=0)) - low + 1) // CELLS)
            cells = ((exact - low) // step).astype(np.uint8)
            return pa.RecordBatch.from_pydict(
                {
                    "dim": pa.array([dim], pa.int32()),
                    "ids": [np.array(ids, "<i8").tobytes()],
                    "exact": [exact.astype("<i8").tobytes()],
                    "low": [low],
                    "step": [step],
                    "cells": [cells.tobytes()],
                }
            )

        for batch in batches:
            vectors = batch.column(1)
            values = vectors.flatten().to_numpy(zero_copy_only=False)
            ends = np.r_[0, np.cumsum(vectors.value_lengths().to_numpy(zero_copy_only=False))]
            for i, key in enumerate(batch.column(0).to_pylist()):
                dim = int(ends[i + 1] - ends[i])
                ids, rows = waiting.setdefault(dim, ([], []))
                ids.append(key)
                rows.append(values[ends[i] : ends[i + 1]])
                if len(ids) == size:
                    yield close(dim)
        for dim in list(waiting):
            yield close(dim)

    schema = "dim int, ids binary, exact binary, low long, step long, cells binary"
    return vectors.mapInArrow(run, schema)


def block_top(
    queries: np.ndarray, own: np.ndarray, best: list[list[tuple[int, int]]], k: int, ids: np.ndarray,
    exact: np.ndarray, low: int, step: int, cells: np.ndarray,
) -> None:
    """Bring each query's ``best`` (score, -id; best first) up to date with one block."""
    corner = queries.astype(float) @ cells.T.astype(float) * step + (queries.sum(1) * float(low))[:, None]
    positive, negative = np.where(queries > 0, queries, 0).sum(1), np.where(queries < 0, queries, 0).sum(1)
    # Sums of floats may be off in the last places once they leave 53 bits.
    slack = 1e-9 * (abs(queries).sum(1) * float(max(abs(low), abs(low + step * CELLS)))) + 1
    upper = corner + (positive * float(step - 1) + slack)[:, None]
    lower = corner + (negative * float(step - 1) - slack)[:, None]
    others = ids[None, :] != own[:, None]
    upper[~others] = lower[~others] = -np.inf
    if len(ids) > k:
        floor = np.partition(lower, -k, axis=1)[:, -k]
    else:
        floor = np.full(len(queries), -np.inf)
    for q in range(len(queries)):
        found = best[q]
        least = max(floor[q], found[k - 1][0] if len(found) >= k else -np.inf)
        wanted = np.flatnonzero((upper[q] >= least) & others[q])
        wanted = wanted[np.argsort(-upper[q, wanted], kind="stable")]
        for start in range(0, len(wanted), _READ):
            if len(found) >= k and upper[q, wanted[start]] < found[k - 1][0]:
                break
            some = wanted[start : start + _READ]
            scores = (exact[some] * queries[q]).sum(1)
            found.extend(zip(scores.tolist(), (-ids[some]).tolist()))
            found.sort(reverse=True)
            del found[k:]


def top_k(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 5,
    scale: int = 256,
) -> DataFrame:
    """``query_id, rank, <id>, score``: the ``k`` best other rows of each row with ``is_query``.

    Components become floor(scale * x); the score is their integer inner product (64 bits),
    ties go to the smaller id. Vectors that are null or hold null or non-finite components,
    and rows without an id, take no part; vectors of different lengths are not
    compared; empty vectors score 0. A query is never compared with rows of its own id. A
    query id that repeats is answered for its row with the smallest vector; repeated candidates count each.
    Fewer than ``k`` others give fewer rows; an empty table none.

    Each block of queries meets each block of vectors once. Tasks keep only the best ``k`` per
    query, so what is ranked at the end is small.
    """
    usable = vectors.select(
        F.col(id_col).cast("long").alias("_id"), quantised(F.col(vector_col), scale).alias("_vector"),
        is_query.alias("_query"),
    ).filter(F.col("_id").isNotNull() & F.col("_vector").isNotNull())
    spark = vectors.sparkSession
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    candidates = blocks(usable.select("_id", "_vector"), BLOCK)
    candidates = candidates.withColumn("_part", F.pmod(F.xxhash64("ids"), F.lit(parts)).cast("int"))
    asked = usable.filter("_query").groupBy("_id").agg(F.min("_vector").alias("_vector"))
    # Few rows per task: gathered so that the blocks are full, however many tasks read them.
    asked = blocks(asked, QUERY_BLOCK).select(F.col("dim").alias("_dim"), F.col("ids").alias("q_ids"), F.col("exact").alias("q_exact"))
    asked = asked.withColumn("_of", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    # Spark takes the copies to be as large as one of them, and would send them all through the driver.
    copies = asked.hint("merge")
    pairs = candidates.join(copies, (F.col("dim") == F.col("_dim")) & (F.col("_part") == F.col("_of"))).select(
        "dim", "ids", "exact", "low", "step", "cells", "q_ids", "q_exact"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple[int, bytes], list[list[tuple[int, int]]]] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                dim, ids, exact, low, step, cells, q_ids, q_exact = (c[row].as_py() for c in batch.columns)
                own, of = np.frombuffer(q_ids, "<i8"), np.frombuffer(ids, "<i8")
                found = best.setdefault((dim, q_ids), [[] for _ in own])
                block_top(
                    np.frombuffer(q_exact, "<i8").reshape(len(own), dim), own, found, k, of,
                    np.frombuffer(exact, "<i8").reshape(len(of), dim), low, step,
                    np.frombuffer(cells, np.uint8).reshape(len(of), dim),
                )
        for (_, q_ids), lists in best.items():
            rows = [(q, -i, s) for q, found in zip(np.frombuffer(q_ids, "<i8").tolist(), lists) for s, i in found]
            if rows:
                columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
                yield pa.RecordBatch.from_arrays(columns, names=["query_id", "found_id", "score"])

    found = pairs.mapInArrow(run, "query_id long, found_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("found_id"))
    return (
        found.withColumn("rank", F.row_number().over(order).cast("int"))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", F.col("found_id").alias(id_col), "score")
    )
