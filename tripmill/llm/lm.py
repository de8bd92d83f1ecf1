"""Language-model scores from a log-frequency Bloom filter.

A count is quantised to its logarithm's level, and the n-gram is put into the filter once
for every level up to its own. Workers probe level after level until one is missing; the
last one found gives the count back. Bigram probabilities are smoothed towards unigrams by a
Dirichlet prior: (c(before, word) + prior * p(word)) / (c(before) + prior).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.scratch import written
from tripmill.llm.text import Powers, freeing, give_back, lower_ascii, mix, slices, word_spans

#: Tokens whose exact counts travel with every task; the others' are joined.
FREQUENT = 1 << 18
#: Filter bits and probes per entry: a probe of an absent one succeeds in about 1 of 150.
BITS, PROBES = 12, 4
#: Levels are powers of this base.
BASE = 2.0
#: Training tokens per block of the filter.
BLOCK_TOKENS = 1 << 18
#: Weight of the unigrams, in counts.
PRIOR = 100.0
#: Bytes of filter a worker holds at once; a larger filter is used in several passes.
SHARD_BYTES = 96 << 20
#: Tokens a task sums up before it hands the sums on.
HELD = 1_000_000
#: Bytes of text hashed at once; arrays of 64 bits for each byte stay small beside the filter.
SLICE_BYTES = 1 << 18

_U = np.uint64
# The hash of a text's end, of what stands before its first word, and a salt.
_END, _BEGIN, _UNIGRAM = _U(0x2545F4914F6CDD1D), _U(0xD6E8FEB86659FD93), _U(0xA0761D6478BD642F)


def token_hashes(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For slices of texts: hashes of words and ends, and the first token of each text.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; every text has one end.
    """
    powers = Powers()
    for _, data, offsets in slices(column, SLICE_BYTES):
        data = lower_ascii(data)
        starts, ends, first = word_spans(data, offsets)
        after = first[1:] + np.arange(len(offsets) - 1)
        hashes = np.empty(len(starts) + len(after), np.uint64)
        inside = np.ones(len(hashes), bool)
        inside[after] = False
        hashes[inside] = powers.ranges(mix(data.astype(np.uint64) + _U(1)), starts, ends)
        hashes[after] = _END
        yield hashes, np.r_[0, after + 1]


def _texts(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def _shifted(values: np.ndarray, first: np.ndarray, begin: np.generic) -> np.ndarray:
    """The value of the token before each one."""
    before = np.empty_like(values)
    before[1:] = values[:-1]
    before[first[:-1]] = begin
    return before


def pair_hashes(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of every token with the one before it."""
    return mix(_shifted(hashes, first, _BEGIN) * _U(0x9E3779B97F4A7C15) + hashes)


@dataclass(frozen=True)
class Corpus:
    """What training counted: tokens, distinct tokens, texts; frequent tokens by hash."""

    tokens: int
    distinct: int
    texts: int
    hashes: np.ndarray
    counts: np.ndarray

    def frequent(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of tokens, and which of them are frequent (0 for the others)."""
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        known = self.hashes[at] == hashes
        return np.where(known, self.counts[at], 0), known

    def scale(self) -> float:
        return self.tokens + 0.5 * (self.distinct + 1)


def vocabulary(docs: DataFrame, text_col: str) -> DataFrame:
    """``hash, n`` of every token; tasks sum up first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hashes, counts in _summed(h for batch in batches for h, _ in token_hashes(batch.column(0))):
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes.view(np.int64)), pa.array(counts, pa.int64())], names=["hash", "n"]
            )

    partial = docs.select(text_col).mapInArrow(freeing(run), "hash long, n long")
    return partial.groupBy("hash").agg(F.sum("n").alias("n"))


def _summed(parts: Iterator[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct values with their counts, for ``HELD`` values at a time."""
    held, size = [], 0
    for part in parts:
        held.append(part)
        size += len(part)
        if size >= HELD:
            yield np.unique(np.concatenate(held), return_counts=True)
            held, size = [], 0
    if size:
        yield np.unique(np.concatenate(held), return_counts=True)


def count_corpus(vocabulary: DataFrame) -> Corpus:
    """Totals and the ``FREQUENT`` most frequent tokens, ties by hash."""
    total = vocabulary.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    end = vocabulary.filter(F.col("hash") == int(_END.view(np.int64))).first()
    rows = vocabulary.orderBy(F.desc("n"), F.asc("hash")).limit(FREQUENT).toArrow()
    hashes = rows["hash"].to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    return Corpus(total.n or 0, total.v, end.n if end else 0, hashes[order], rows["n"].to_numpy()[order])


def levels(counts: np.ndarray) -> np.ndarray:
    """The level of each count: 1 for 1, one more for each power of the base."""
    return 1 + np.floor(np.log(np.maximum(counts, 1)) / np.log(BASE) + 1e-9).astype(np.int64)


def level_counts(level: np.ndarray) -> np.ndarray:
    """The middle of a level's counts; 0 for level 0."""
    low = BASE ** np.maximum(level - 1, 0)
    return np.where(level > 0, (np.ceil(low) + np.ceil(low * BASE) - 1) / 2, 0.0)


def _probes(hashes: np.ndarray, level: np.ndarray, bits: np.ndarray) -> Iterator[np.ndarray]:
    one = mix(hashes + level.astype(np.uint64) * _U(0xE7037ED1A0B428DB))
    two = mix(one) | _U(1)
    for i in range(PROBES):
        yield ((one + _U(i) * two) % bits).astype(np.int64)


def filled(hashes: np.ndarray, counts: np.ndarray) -> bytes:
    """One block of the filter."""
    level = levels(counts)
    entries = np.repeat(hashes, level)
    step = np.arange(len(entries)) - np.repeat(np.cumsum(level) - level, level) + 1
    bits = max(64, -(-len(entries) * BITS // 64) * 64)
    table = np.zeros(bits, bool)
    for at in _probes(entries, step, np.full(len(entries), bits, np.uint64)):
        table[at] = True
    return np.packbits(table, bitorder="little").tobytes()


class LogBloom:
    """Those blocks of a filter that a worker holds, on end; ``blocks`` is not kept."""

    def __init__(self, blocks: dict[int, bytes | pa.Buffer], total: int) -> None:
        self.sizes = np.zeros(total, np.int64)
        for number, block in blocks.items():
            self.sizes[number] = len(block)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(blocks[n] for n in sorted(blocks)), np.uint8)

    def count(self, hashes: np.ndarray, block: np.ndarray) -> np.ndarray:
        """The quantised count of each n-gram in its block, by probes of level after level."""
        level = np.zeros(len(hashes), np.int64)
        left = np.flatnonzero(self.sizes[block] > 0)
        step = 1
        while len(left):
            starts, bits = self.starts[block[left]], (self.sizes[block[left]] * 8).astype(np.uint64)
            found = np.ones(len(left), bool)
            for at in _probes(hashes[left], np.full(len(left), step), bits):
                found &= (self.bytes[starts + (at >> 3)] >> (at & 7).astype(np.uint8) & 1).astype(bool)
            left = left[found]
            level[left] = step
            step += 1
        return level_counts(level)


def _block(keys: np.ndarray, total: int) -> np.ndarray:
    return (mix(keys ^ _U(0x8BB84B93962EACC9)) % _U(total)).astype(np.int64)


def ngram_filter(docs: DataFrame, vocabulary: DataFrame, text_col: str, sent: Broadcast, total: int) -> DataFrame:
    """``block, bits``: the filter of all bigrams, and of the tokens that are not frequent.

    A bigram that ends in a frequent token lies in a block of its own hash, any other in its
    last token's block, where that token's count is, too. Tasks sum bigrams up and hand
    each block's on as arrays; a block is filled by one task, and blocks grow in number with
    the corpus, not in size.
    """

    def dealt(hashes: np.ndarray, counts: np.ndarray, block: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(block, kind="stable")
        hashes, counts, block = hashes[order], counts[order], block[order]
        edges = np.flatnonzero(np.r_[True, block[1:] != block[:-1], True]) if len(block) else np.zeros(1, int)
        spans = list(zip(edges[:-1].tolist(), edges[1:].tolist()))
        large = counts >= 255
        return pa.RecordBatch.from_arrays(
            [
                pa.array([int(block[a]) for a, _ in spans], pa.int64()),
                pa.array([hashes[a:b].tobytes() for a, b in spans], pa.binary()),
                pa.array([np.minimum(counts[a:b], 255).astype(np.uint8).tobytes() for a, b in spans], pa.binary()),
                pa.array([counts[a:b][large[a:b]].astype("<i8").tobytes() for a, b in spans], pa.binary()),
            ],
            names=["block", "hashes", "counts", "large"],
        )

    def bigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        pairs, blocks, size = [], [], 0

        def close() -> pa.RecordBatch:
            every, first, counts = np.unique(np.concatenate(pairs), return_index=True, return_counts=True)
            block = np.concatenate(blocks)[first]
            pairs.clear()
            blocks.clear()
            return dealt(every, counts, block)

        for batch in batches:
            for hashes, first in token_hashes(batch.column(0)):
                pairs.append(pair_hashes(hashes, first))
                blocks.append(_block(np.where(own.frequent(hashes)[1], pairs[-1], hashes), total))
                size += len(hashes)
                if size >= HELD:
                    yield close()
                    size = 0
        if size:
            yield close()

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            hashes = batch.column(0).to_numpy().view(np.uint64)
            new = ~own.frequent(hashes)[1]
            hashes = hashes[new]
            yield dealt(mix(hashes ^ _UNIGRAM), batch.column(1).to_numpy()[new], _block(hashes, total))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[bytes, bytes, bytes]]] = {}
        for batch in batches:
            for block, *rest in zip(*(c.to_pylist() for c in batch.columns)):
                held.setdefault(block, []).append(tuple(rest))
        while held:
            block, rows = held.popitem()
            hashes = np.concatenate([np.frombuffer(h, np.uint64) for h, _, _ in rows])
            counts = np.concatenate([np.frombuffer(c, np.uint8) for _, c, _ in rows]).astype(np.int64)
            counts[counts == 255] = np.concatenate([np.frombuffer(x, "<i8") for _, _, x in rows])
            keys, where = np.unique(hashes, return_inverse=True)
            bits = filled(keys, np.bincount(where, counts).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([bits], pa.binary())], names=["block", "bits"]
            )

    schema = "block long, hashes binary, counts binary, large binary"
    parts = docs.select(text_col).mapInArrow(freeing(bigrams), schema)
    parts = parts.unionByName(vocabulary.select("hash", "n").mapInArrow(freeing(rare), schema))
    wide = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return parts.repartition(max(wide, -(-total // 4)), "block").mapInArrow(freeing(build), "block long, bits binary")


def score(
    docs: DataFrame,
    training: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    prior: float = PRIOR,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: its id column, ``n_tokens, n_known, train_tokens,
    base_score, score``.

    The model learns from all rows for which ``training`` holds. ``base_score`` is the exact
    unigram score, ``score`` the bigram model's log10 probability; of it the unigram part
    and the counts of contexts are exact, those of bigrams come from the filter. With
    nothing to learn from, every count is 0. A null text is an empty one: its end is its
    only token. Repeated rows are learned from, and scored, once each; null ids are kept.
    Other columns are not carried. Tokens are told apart by 64-bit hashes.

    The counts of ``FREQUENT`` tokens travel with the tasks; those of others are joined. The
    filter grows with the corpus. A worker holds ``shard_bytes`` of it at most: a larger one
    is broadcast and used piece by piece.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("_hash"), F.col(text_col).alias("_text")
    )
    learned = docs.filter(F.coalesce(training, F.lit(False))).select(F.col(text_col).alias("_text"))
    words = written(vocabulary(learned, "_text"), "vocabulary")
    corpus = count_corpus(words)
    frequent = spark.sparkContext.broadcast(corpus)
    total = max(1, -(-corpus.tokens // BLOCK_TOKENS))
    blocks = written(ngram_filter(learned, words, "_text", frequent, total), "filter")
    size = blocks.agg(F.sum(F.length("bits"))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))
    kind = rows.schema["_id"].dataType.simpleString()
    parts = [_rare_part(rows, kind, words, corpus, frequent, prior)]
    for shard in range(shards):
        sent = spark.sparkContext.broadcast(_gathered(blocks.filter(F.pmod("block", F.lit(shards)) == shard), total))
        give_back()
        parts.append(_known_part(rows, kind, frequent, sent, total, shard, shards, prior))
        if shards > 1:
            parts[-1] = written(parts[-1], "scores")
            sent.destroy()
    sums = parts[0]
    for more in parts[1:]:
        sums = sums.unionByName(more)
    names = ["_copies", "n_tokens", "n_known", "base", "score"]
    sums = sums.groupBy("_id", "_hash").agg(*[F.sum(n).alias(n) for n in names])
    # Rows equal in id and text were summed up together: each gets its share.
    return sums.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_copies"))).select(
        F.col("_id").alias(id_col),
        F.expr("n_tokens div _copies").alias("n_tokens"),
        F.expr("n_known div _copies").alias("n_known"),
        F.lit(corpus.tokens).cast("long").alias("train_tokens"),
        (F.col("base") / F.col("_copies")).alias("base_score"),
        (F.col("score") / F.col("_copies")).alias("score"),
    )


def _gathered(blocks: DataFrame, total: int) -> LogBloom:
    """A shard of the filter as workers use it: they hold its bytes once."""
    mine = blocks.toArrow()
    return LogBloom(dict(zip(mine["block"].to_pylist(), (bits.as_buffer() for bits in mine["bits"]))), total)


def _rare_part(
    rows: DataFrame, kind: str, words: DataFrame, corpus: Corpus, frequent: Broadcast, prior: float
) -> DataFrame:
    """What tokens that are not frequent add to each text's sums, from a join on the token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = frequent.value
        for batch in batches:
            row = 0
            for hashes, first in token_hashes(batch.column(2)):
                text = _texts(hashes, first)
                new = ~own.frequent(hashes)[1]
                text, rare = text[new], hashes[new]
                order = np.lexsort((rare, text))
                text, rare = text[order], rare[order]
                edge = np.flatnonzero(np.r_[True, (text[1:] != text[:-1]) | (rare[1:] != rare[:-1])][: len(text)])
                which = pa.array(text[edge] + row)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(which),
                        batch.column(1).take(which),
                        pa.array(rare[edge].view(np.int64)),
                        pa.array(np.diff(np.r_[edge, len(text)]).astype(np.int64)),
                    ],
                    names=["_id", "_hash", "hash", "times"],
                )
                row += len(first) - 1

    rare = rows.mapInArrow(freeing(run), f"_id {kind}, _hash long, hash long, times long").join(words, "hash", "left")
    n, times, zero = F.coalesce("n", F.lit(0)), F.col("times"), F.lit(0).cast("long")
    base = times * F.log10((n + 0.5) / F.lit(corpus.scale()))
    context = F.when(F.col("hash") == int(_END.view(np.int64)), 0.0).otherwise(times * F.log10(n + prior))
    return rare.select(
        "_id",
        "_hash",
        zero.alias("_copies"),
        zero.alias("n_tokens"),
        F.when(n > 0, times).otherwise(zero).alias("n_known"),
        base.alias("base"),
        (base - context).alias("score"),
    )


def _known_part(
    rows: DataFrame, kind: str, frequent: Broadcast, sent: Broadcast, total: int, shard: int, shards: int, prior: float
) -> DataFrame:
    """What frequent tokens and the bigrams in one shard of the filter add to each text's sums.

    The smoothed probability is that of an unseen bigram, prior * p(word) / (c(before) +
    prior), times 1 + c(before, word) / (prior * p(word)). The first factor's parts add up over
    tokens and go with the first shard; the second is left out where the count is 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, bloom = frequent.value, sent.value
        for batch in batches:
            row = 0
            for hashes, first in token_hashes(batch.column(2)):
                n, text = len(first) - 1, _texts(hashes, first)
                counts, known = own.frequent(hashes)
                pairs = pair_hashes(hashes, first)
                block = _block(np.where(known, pairs, hashes), total)
                mine = np.flatnonzero(block % shards == shard) if shards > 1 else np.arange(len(pairs))
                both = np.zeros(len(pairs))
                both[mine] = bloom.count(pairs[mine], block[mine])
                seen = np.flatnonzero(both)
                guess = counts[seen].astype(float)
                rare = ~known[seen]
                guess[rare] = bloom.count(mix(hashes[seen[rare]] ^ _UNIGRAM), block[seen[rare]])
                before = _shifted(np.where(known, counts, np.iinfo(np.int64).max), first, np.int64(own.texts))
                both = np.minimum(both[seen], np.minimum(before[seen], np.maximum(guess, 1.0)))
                more = np.log10(1 + both * own.scale() / (prior * (guess + 0.5)))
                score = np.bincount(text[seen], more, n).astype(float)
                sums = [np.zeros(n, np.int64)] * 3 + [np.zeros(n)]
                if not shard:
                    base = np.where(known, np.log10((counts + 0.5) / own.scale()), 0.0)
                    context = np.where(known & (hashes != _END), np.log10(counts + prior), 0.0)
                    tokens = np.diff(first)
                    sums = [
                        np.ones(n, np.int64),
                        tokens,
                        np.bincount(text, known, n).astype(np.int64),
                        np.bincount(text, base, n),
                    ]
                    score += np.bincount(text, base - context, n) + tokens * np.log10(prior) - np.log10(own.texts + prior)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, n), batch.column(1).slice(row, n), *map(pa.array, sums), pa.array(score)],
                    names=["_id", "_hash", "_copies", "n_tokens", "n_known", "base", "score"],
                )
                row += n

    schema = f"_id {kind}, _hash long, _copies long, n_tokens long, n_known long, base double, score double"
    return rows.mapInArrow(freeing(run), schema)
