"""Ranked lexical search in which documents with equal bags are scored once.

For a set of items only the items' own terms matter. A document is reduced to its bag: the
numbers and frequencies of those terms, and its length as the score sees it. Documents are
grouped by a hash of the bag and by the bag itself, so a class holds identical bags and nothing
else. Each class is scored once against all items, and its members, smallest ids first, take
their places in the ranking.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tripmill.llm.scratch import written
from tripmill.llm.text import lower_ascii, slices, utf8

TOP = 10

#: Bytes of item terms that are searched for at once, and so held by every task; more items are
#: searched in several rounds.
BLOCK_BYTES = 16 << 20

#: Bytes of text whose terms are found at once; (class, item) scores and postings held at once.
SLICE_BYTES = 8 << 20
CELLS = 1 << 21


def terms(column: pa.Array) -> Iterator[tuple[int, int, pa.Array, np.ndarray]]:
    """Slices of the column: first row, number of texts, their terms in order, and each term's text.

    Terms are the maximal runs of ASCII letters and digits and of characters beyond ASCII; A-Z
    are lower-cased.
    """
    inside_term = np.zeros(256, bool)
    inside_term[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
    for row, data, offsets in slices(column, SLICE_BYTES):
        data = lower_ascii(data)
        inside = inside_term[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        begins = offsets[:-1][offsets[:-1] < offsets[1:]]
        first[begins] = inside[begins]
        starts = np.flatnonzero(first)
        bounds = np.r_[0, np.cumsum(inside)][np.r_[starts, len(data)]].astype(np.int64)
        found = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data[inside])]
        )
        yield row, len(offsets) - 1, found, np.searchsorted(offsets, starts, side="right") - 1


def item_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """``_item, term``: each item's distinct terms; rows that repeat an item's id are one item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, _, found, text in terms(batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(text + row)), found.cast(pa.binary())], names=["_item", "term"]
                )

    kind = items.schema[item_col].dataType.simpleString()
    return items.select(F.col(item_col).alias("_item"), text_col).mapInArrow(run, f"_item {kind}, term binary").distinct()


def blocked(found: DataFrame) -> tuple[DataFrame, int]:
    """Item terms with the number of their ``block``, and how many blocks there are.

    No block holds more than ``BLOCK_BYTES``, or more than one item where that one holds more.
    """
    sizes = found.groupBy("_item").agg(F.sum(F.length("term") + 16).alias("_size"))
    total, largest = sizes.agg(F.sum("_size"), F.max("_size")).first()
    blocks = -(-(total or 0) // BLOCK_BYTES)
    while blocks > 1:
        block = F.pmod(F.xxhash64("_item"), F.lit(blocks))
        most = sizes.groupBy(block.alias("block")).agg(F.sum("_size").alias("_size")).agg(F.max("_size")).first()[0]
        if most <= max(BLOCK_BYTES, largest):
            break
        blocks *= 2
    number = F.pmod(F.xxhash64("_item"), F.lit(max(blocks, 1))).cast("int")
    return found.withColumn("block", number), blocks


class Wanted:
    """The items of one block, the distinct terms in them, and which items each term is in."""

    def __init__(self, found: pa.Table) -> None:
        items = found["_item"].combine_chunks().dictionary_encode("encode")
        words = found["term"].combine_chunks().cast(pa.large_binary()).dictionary_encode()
        self.items, self.terms = items.dictionary, words.dictionary
        term = words.indices.to_numpy()
        order = np.argsort(term, kind="stable")
        self.item = items.indices.to_numpy()[order].astype(np.int64)
        self.start = np.searchsorted(term[order], np.arange(len(self.terms) + 1))


def bags(docs: DataFrame, vocabulary: pa.Array, id_col: str, text_col: str) -> DataFrame:
    """``_id, n, bag``: a document's number of terms, and (term, frequency) pairs of 32-bit numbers
    for those in ``vocabulary``, in the order of their numbers there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, texts, found, text in terms(batch.column(1)):
                number = pc.index_in(found, value_set=vocabulary).fill_null(-1).to_numpy()
                known = number >= 0
                pair, times = np.unique(text[known] * max(len(vocabulary), 1) + number[known], return_counts=True)
                owner, term = np.divmod(pair, max(len(vocabulary), 1))
                ends = 8 * np.searchsorted(owner, np.arange(texts + 1))
                held = np.stack([term, times], 1).astype("<i4").tobytes()
                bag = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), texts, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(held)]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, texts),
                        pa.array(np.bincount(text, minlength=texts), pa.int64()),
                        bag.cast(pa.binary()),
                    ],
                    names=["_id", "n", "bag"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("_id"), text_col).mapInArrow(run, f"_id {kind}, n long, bag binary")


def _pairs(bag: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms and frequencies of bags on end, and where each bag's pairs end."""
    data, ends = utf8(bag)
    pairs = np.frombuffer(data[ends[0] : ends[-1]].tobytes(), "<i4").reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1], (ends - ends[0]) // 8


def frequencies(found: DataFrame, terms: int) -> tuple[np.ndarray, int, int]:
    """For each term how many bags hold it; how many documents have terms, and how many they have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(terms + 2, np.int64)
        for batch in batches:
            term, _, _ = _pairs(batch.column(1))
            held[:terms] += np.bincount(term, minlength=terms)
            n = batch.column(0).to_numpy()
            held[terms:] += (np.count_nonzero(n), n.sum())
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(held[at])], names=["term", "n"])

    # A task hands on one row per term of the block, and the driver gets one per term.
    rows = found.select("n", "bag").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    out = np.zeros(terms + 2, np.int64)
    for r in rows.collect():
        out[r.term] = r.n
    return out[:terms], int(out[terms]), int(out[terms + 1])


def classes(found: DataFrame, documents: int, total: int, top: int) -> DataFrame:
    """``m, bag, members``: distinct bags, each with the ``top`` smallest ids that have it.

    The hash deals bags out; it is the bag and ``m`` themselves that make a class. No more than
    ``top`` rows of a class leave a task, so one that holds a third of all rows is as cheap as any.
    """
    m = F.expr(f"10 + (90 * n * {documents}L) div {total}L").alias("m")
    member = F.struct(F.col("_id").isNull().alias("no_id"), "_id").alias("member")
    rows = found.filter(F.length("bag") > 0).select(m, "bag", member)
    rows = rows.withColumn("hash", F.xxhash64("m", "bag"))
    same = ["hash", "m", "bag"]
    rows = rows.withColumn("_nth", F.row_number().over(Window.partitionBy(*same).orderBy("member")))
    rows = rows.filter(F.col("_nth") <= top)
    return rows.groupBy(*same).agg(F.array_sort(F.collect_list("member")).alias("members")).drop("hash")


def _best(found: pa.Table, top: int) -> pa.Table:
    """The ``top`` classes of each item: highest score, then smallest first member."""
    keys = [("item", "ascending"), ("score", "descending"), ("no_id", "ascending"), ("least", "ascending")]
    found = found.take(pc.sort_indices(found, sort_keys=keys, null_placement="at_end"))
    item = found["item"].to_numpy()
    nth = np.arange(len(item)) - np.searchsorted(item, item)
    return found.filter(pa.array(nth < top))


def scored(found: DataFrame, wanted: Wanted, weight: np.ndarray, top: int, item_kind: str) -> DataFrame:
    """``_item, score, members``: of each task's classes the ``top`` best for each item.

    A class brings one member at least, so whatever ranks among the ``top`` documents is a
    member of one of these classes in some task.
    """
    items = len(wanted.items)

    def scores(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
        """Runs of classes: the first one's row, and the scores of each for all items."""
        m = batch.column("m").to_numpy()
        term, tf, ends = _pairs(batch.column("bag"))
        tf = tf.astype(np.int64)
        owner = np.repeat(np.arange(len(m)), np.diff(ends))
        part = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[owner]))
        postings = wanted.start[term + 1] - wanted.start[term]
        reached = np.r_[0, np.cumsum(postings)][ends]
        low = 0
        while low < len(m):
            high = int(np.searchsorted(reached, reached[low] + CELLS, side="right")) - 1
            high = max(low + 1, min(high, len(m), low + max(1, CELLS // items)))
            own = slice(ends[low], ends[high])
            n = postings[own]
            at = np.arange(n.sum()) + np.repeat(wanted.start[term[own]] - (np.cumsum(n) - n), n)
            cell = np.repeat((owner[own] - low) * items, n) + wanted.item[at]
            # Doubles add up whole numbers exactly below 2**53, so high and low bits go apart.
            sums = [
                np.bincount(cell, np.repeat(bits.astype(np.float64), n), (high - low) * items).astype(np.int64)
                for bits in (part[own] >> 20, part[own] & 0xFFFFF)
            ]
            yield low, ((sums[0] << 20) + sums[1]).reshape(high - low, items)
            low = high

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bar = np.ones(items, np.int64)  # what a class must score to be among an item's best so far
        best = None
        for batch in batches:
            held = [] if best is None else [best]
            for low, score in scores(batch):
                least = bar
                if len(score) > top:
                    least = np.maximum(bar, np.partition(score, len(score) - top, axis=0)[-top])
                row, item = np.nonzero(score >= least)
                members = batch.column("members").take(pa.array(low + row))
                first = members.flatten().take(pa.array(np.r_[0, np.cumsum(pc.list_value_length(members))][:-1]))
                held.append(
                    pa.table(
                        {
                            "item": pa.array(item),
                            "score": pa.array(score[row, item]),
                            "no_id": first.field(0),
                            "least": first.field(1),
                            "members": members,
                        }
                    )
                )
                if len(held) > 8:
                    held = [_best(pa.concat_tables(held), top)]
            best = _best(pa.concat_tables(held), top).combine_chunks() if held else best
            if best is not None and len(best) >= top:
                item = best["item"].to_numpy()
                last = np.flatnonzero(item[top - 1 :] == item[: len(item) - top + 1]) + top - 1
                bar[item[last]] = best["score"].to_numpy()[last]
        if best is not None and len(best):
            own = pa.table({"_item": wanted.items.take(best["item"].combine_chunks())})
            for name in ("score", "members"):
                own = own.append_column(name, best[name])
            yield from own.combine_chunks().to_batches()

    schema = T.StructType([T.StructField("score", T.LongType()), found.schema["members"]])
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    return found.mapInArrow(run, f"_item {item_kind}, {kinds}")


def search(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    top: int = TOP,
) -> DataFrame:
    """The ``top`` best documents of each item: its id column, ``rank``, the document's id column, ``score``.

    A document's terms are those of its whole text (``terms``). With N documents that have terms
    and L terms in all of them, a document of n terms has m = 10 + (90 * n * N) div L; a term
    held by df documents weighs w = floor(1000 * ln((2 * N + 2) / (2 * df + 1))). The score
    sums w * ((10 ** 9 * tf) div (1000 * tf + 8 * m)) over the item's distinct terms.
    Documents of score 0 are not ranked, equal scores are ranked by ascending id, null ids last.

    Every row of ``docs`` is a document, copies included; a null or empty text has no terms. Rows
    of ``items`` that repeat an id, null among them, are one item with the terms of them all; one without
    terms gets no row. Empty tables give an empty result. Other columns are not carried.

    The items are searched for in blocks of ``BLOCK_BYTES`` of terms: only a block's terms, with
    their weights, are held by the tasks, and the documents are read once per block.
    """
    if item_col == id_col or {item_col, id_col} & {"rank", "score"}:
        raise ValueError("the id columns need names of their own")
    spark = docs.sparkSession
    item_kind = items.schema[item_col].dataType
    result = T.StructType(
        [
            T.StructField(item_col, item_kind),
            T.StructField("rank", T.IntegerType()),
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("score", T.LongType()),
        ]
    )
    found, blocks = blocked(written(item_terms(items, item_col, item_text_col), "item-terms"))
    ranked = []
    for block in range(blocks):
        wanted = Wanted(found.filter(F.col("block") == block).select("_item", "term").toArrow())
        if not len(wanted.items):
            continue
        bag = written(bags(docs, wanted.terms, id_col, text_col), "bags")
        held, documents, total = frequencies(bag, len(wanted.terms))
        if not documents:
            break
        weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in held.tolist()], np.int64)
        best = scored(classes(bag, documents, total, top), wanted, weight, top, item_kind.simpleString())
        rows = best.select("_item", "score", F.explode("members").alias("member"))
        order = Window.partitionBy("_item").orderBy(F.desc("score"), "member")
        rows = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
        ranked.append(rows.select(F.col("_item").alias(item_col), "rank", F.col("member._id").alias(id_col), "score"))
    if not ranked:
        return spark.createDataFrame([], result)
    every = ranked[0]
    for more in ranked[1:]:
        every = every.unionByName(more)
    return every
