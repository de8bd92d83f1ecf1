"""Language identification by rank-order profiles of character n-grams.

A profile lists the most frequent n-grams of a language in order. A text's own list is
compared with each profile: every n-gram adds how far out of place it is, and one that the
profile lacks adds the most. The language with the smallest sum wins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.llm.text import refuse_taken

UNKNOWN = "und"
PROFILE = 400
LONGEST = 3
#: N-grams a task sums up before it hands the sums on.
HELD = 4_000_000

#: Parts in which the most frequent n-grams of a language are first looked for.
_SALTS = 32

#: Stands for a word's edge; no letter has this code point.
_EDGE = 1
_BITS = 21
_LETTERS = 1 << 17


def letter_table() -> np.ndarray:
    """Which of the first ``_LETTERS`` code points are letters."""
    return np.array([chr(i).isalpha() for i in range(_LETTERS)])


def grams(text: str, letters: np.ndarray) -> np.ndarray:
    """The n-grams of one to ``LONGEST`` letters of a text in lower case, repeats included.

    A word is a run of letters, with an edge on both sides; an n-gram stays in one word. It is
    written as its code points, 21 bits each.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    letter = letters[np.minimum(points, _LETTERS - 1)]
    for i in np.flatnonzero(points >= _LETTERS).tolist():
        letter[i] = chr(points[i]).isalpha()
    after = np.zeros(len(points), bool)
    after[1:] = letter[:-1]
    chain = np.full(len(points) + 2, _EDGE, np.int64)
    kept = np.where(letter, points, _EDGE)[letter | after]
    chain[1 : len(kept) + 1] = kept
    chain = chain[: len(kept) + (1 if len(kept) and kept[-1] == _EDGE else 2)]
    found = [chain[chain != _EDGE]]
    codes, inner = chain, np.ones(len(chain), bool)
    for n in range(2, LONGEST + 1):
        codes = codes[:-1] << _BITS | chain[n - 1 :]
        if n > 2:
            inner = inner[:-1] & (chain[n - 2 : -1] != _EDGE)
        else:
            inner = inner[:-1]
        found.append(codes[inner])
    return np.concatenate(found) if len(found[0]) else found[0]


def gram_counts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """``lang, gram, n`` over all texts, summed in each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = letter_table()
        held: dict[str, list[np.ndarray]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang in list(held):
                codes, counts = np.unique(np.concatenate(held.pop(lang)), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(codes), pa.string()), pa.array(codes, pa.int64()), pa.array(counts, pa.int64())],
                    names=["lang", "gram", "n"],
                )

        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist()):
                found = grams(text.as_py(), letters)
                held.setdefault(lang, []).append(found)
                size += len(found)
                if size > HELD:
                    yield from flush()
                    size = 0
        yield from flush()

    known = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).dropna()
    partial = known.mapInArrow(run, "lang string, gram long, n long")
    return partial.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = PROFILE) -> dict[str, list[int]]:
    """The ``size`` most frequent n-grams of each language, ties in the order of their codes.

    Counts cover every text with a language. The best are found in parts first, so no task
    sorts all n-grams of a language; ``size`` rows per language come to the driver.
    """
    best = [F.desc("n"), F.asc("gram")]
    counts = gram_counts(docs, text_col, lang_col).withColumn("_part", F.pmod(F.xxhash64("gram"), F.lit(_SALTS)))
    for keys in (["lang", "_part"], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*best))
        counts = counts.withColumn("rank", rank).filter(F.col("rank") <= size)
    found: dict[str, list[int]] = {}
    for row in counts.select("lang", "gram", "rank").orderBy("lang", "rank").collect():
        found.setdefault(row.lang, []).append(row.gram)
    return found


def identify(
    docs: DataFrame,
    languages: dict[str, list[int]],
    text_col: str = "text",
    size: int = PROFILE,
) -> DataFrame:
    """The rows of ``docs`` with ``lang_pred`` and ``lang_score`` (0 to 1).

    A null text, a text without letters, and any text when there is no profile give
    ``und`` and 0. Ties between languages go to the name that sorts first. The score is 1
    minus the winner's distance over the largest possible one. A table that has a column of
    these names is refused.
    """
    refuse_taken(docs, "lang_pred", "lang_score")
    names = sorted(languages)
    fixed = np.array(sorted({g for n in names for g in languages[n]}), np.int64)
    places = np.full((len(names), len(fixed)), -1, np.int64)
    for i, name in enumerate(names):
        places[i, np.searchsorted(fixed, languages[name])] = np.arange(len(languages[name]))
    # Equal counts in a text are ordered by the n-gram's places in the profiles, then by its code.
    usual = np.where(places >= 0, places, size).sum(0)
    schema = T.StructType(
        [
            *docs.schema.fields,
            T.StructField("lang_pred", T.StringType()),
            T.StructField("lang_score", T.DoubleType()),
        ]
    )
    at = docs.columns.index(text_col)

    def of(text: str, letters: np.ndarray) -> tuple[str, float]:
        codes, counts = np.unique(grams(text, letters), return_counts=True)
        if not len(codes) or not len(fixed):
            return UNKNOWN, 0.0
        if len(codes) > size:
            keep = counts >= np.partition(counts, -size)[-size]
            codes, counts = codes[keep], counts[keep]
        where = np.minimum(np.searchsorted(fixed, codes), len(fixed) - 1)
        known = fixed[where] == codes
        order = np.lexsort((codes, np.where(known, usual[where], size * len(names)), -counts))[:size]
        known, where = known[order], where[order]
        place = places[:, where[known]]
        out = np.where(place >= 0, abs(place - np.flatnonzero(known)), size).sum(1) + size * int((~known).sum())
        winner = int(out.argmin())
        return names[winner], 1 - float(out[winner]) / (size * len(order))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = letter_table()
        for batch in batches:
            found = [of(text.as_py() or "", letters) for text in batch.column(at)]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([name for name, _ in found], pa.string()),
                    pa.array([value for _, value in found], pa.float64()),
                ],
                names=schema.fieldNames(),
            )

    return docs.mapInArrow(run, schema)
