"""A small filter of wanted rows, held by every task that reads the others."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.scratch import written

#: Bits per wanted row, and bits in all: 4 MiB in half a million words, whatever the number of rows.
BITS_PER_ROW = 16
MAX_BITS = 1 << 25


@dataclass(frozen=True)
class Marks:
    """One bit per hash value; a wanted row always passes, another one if it shares a bit."""

    words: np.ndarray

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        bit = hashes.view(np.uint64) & np.uint64(64 * len(self.words) - 1)
        return (self.words[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)


def _words(wanted: DataFrame) -> tuple[DataFrame, int]:
    """``word, bits``: the filter's non-zero words, and how many bits it has.

    With more rows than it has room for, more of the others pass; none of the wanted is lost.
    """
    rows = wanted.count()
    size = 64
    while size < min(MAX_BITS, BITS_PER_ROW * rows):
        size *= 2
    bit = f"(mark & {size - 1}L)"
    mask = F.expr(f"shiftleft(1L, cast({bit} & 63L AS int))")
    return wanted.groupBy(F.expr(f"shiftright({bit}, 6)").alias("word")).agg(F.bit_or(mask).alias("bits")), size


def marks(wanted: DataFrame) -> Marks:
    """The filter of ``wanted`` (``mark``, a 64-bit hash), for use inside a Python task.

    Its words are put together on the executors; the driver gets each of them once.
    """
    found, size = _words(wanted)
    rows = found.toArrow()
    words = np.zeros(size // 64, np.uint64)
    words[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return Marks(words)


def apart(rows: DataFrame, wanted: DataFrame, mark: Column) -> tuple[DataFrame, DataFrame]:
    """``rows`` that may be among ``wanted`` (``mark``), and those that are not.

    A join of the first with what is wanted leaves the others, often nearly all, where they
    are. ``rows`` are read twice; the filter's words are few enough to be broadcast.
    """
    found, size = _words(wanted)
    words = F.broadcast(written(found, "words").select(F.col("word").alias("_word"), F.col("bits").alias("_bits")))
    bit = mark.bitwiseAND(F.lit(size - 1))
    marked = rows.withColumn("_bit", bit).withColumn("_at", F.shiftright("_bit", 6))
    looked = marked.join(words, F.col("_at") == F.col("_word"), "left")
    held = F.coalesce(F.expr("shiftrightunsigned(_bits, cast(_bit & 63L AS int)) & 1L"), F.lit(0)) == 1
    return looked.filter(held).select(*rows.columns), looked.filter(~held).select(*rows.columns)
