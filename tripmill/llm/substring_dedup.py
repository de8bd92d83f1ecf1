"""Substring dedup over words with one compressed FM-index per shard.

A shard's fragments are indexed by their Burrows-Wheeler transform in a wavelet tree (laid
out as a matrix of bit vectors). The fragments are streamed against it: from every word,
backward search extends the match to the left while the text occurs elsewhere, which gives
the matching statistics; matches that reach the threshold are reported if an earlier
occurrence exists.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tripmill.llm.repeats import Rule, Shard, keyed, merged, repeated_spans, with_spans
from tripmill.llm.text import Powers, freeing, mix, parted, word_spans

WINDOW = 20
GRAM = 4
SHARD_WORDS = 300_000


class Bits:
    """A bit vector with rank: 64-bit words and the ones before each."""

    def __init__(self, bits: np.ndarray) -> None:
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros(len(bits) // 64 + 1, np.uint64)
        words.view(np.uint8)[: len(packed)] = packed
        self.words = words
        self.before = np.zeros(len(words), np.int64)
        np.cumsum(np.bitwise_count(words[:-1]), out=self.before[1:])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first ``i`` bits."""
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletMatrix:
    """Rank of any symbol in a sequence of small numbers."""

    def __init__(self, symbols: np.ndarray) -> None:
        self.bits = max(1, int(symbols.max(initial=0)).bit_length())
        self.levels: list[tuple[Bits, int]] = []
        for level in range(self.bits - 1, -1, -1):
            bit = (symbols >> level & 1).astype(bool)
            self.levels.append((Bits(bit), int(len(bit) - bit.sum())))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often ``symbol`` is among the first ``i``, for arrays of both."""
        low = np.zeros_like(i)
        for level, (bits, zeros) in enumerate(self.levels):
            one = (symbol >> (self.bits - 1 - level) & 1).astype(bool)
            a, b = bits.rank(low), bits.rank(i)
            low = np.where(one, zeros + a, low - a)
            i = np.where(one, zeros + b, i - b)
        return i - low


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Start of every suffix in order, by prefix doubling."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    width = 1
    while True:
        after = np.zeros(n, np.int64)
        after[: n - width] = rank[width:] + 1 if width < n else 0
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.r_[0, np.cumsum(ordered[1:] != ordered[:-1])]
        width *= 2
        if width >= n or rank[order[-1]] == n - 1:
            return order


class FMIndex:
    """Backward search over texts; number 0 ends each text, words are numbers from 1."""

    def __init__(self, texts: list[np.ndarray]) -> None:
        sizes = np.array([len(t) + 1 for t in texts])
        self.starts = np.r_[0, np.cumsum(sizes)]
        ends = self.starts[1:] - 1
        self.text = np.zeros(self.starts[-1], np.int64)
        inside = np.ones(len(self.text), bool)
        inside[ends] = False
        self.text[inside] = np.concatenate(texts)
        distinct = self.text + len(texts)  # ends of texts differ, so no comparison runs past one
        distinct[ends] = np.arange(len(texts))
        self.suffixes = suffix_array(distinct)
        self.bwt = WaveletMatrix(self.text[self.suffixes - 1])
        self.smaller = np.r_[0, np.cumsum(np.bincount(self.text))]

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """From the rows of patterns to the rows of ``symbol`` followed by them."""
        base = self.smaller[symbol]
        return base + self.bwt.rank(symbol, low), base + self.bwt.rank(symbol, high)

    def first_place(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The first text position in each range of rows; ranges are equal or disjoint."""
        ranges, which = np.unique(low, return_inverse=True)
        tops = np.empty(len(ranges), np.int64)
        tops[which] = high
        edges = np.stack([ranges, tops], 1).ravel()
        padded = np.r_[self.suffixes, np.iinfo(np.int64).max]
        return np.minimum.reduceat(padded, edges)[::2][which]


def earlier_windows(shard: Shard, window: int) -> list[tuple[int, int, int]]:
    """Spans of windows of a shard's fragments that also start earlier in the shard."""
    data = np.frombuffer(b"\n".join(shard.texts), np.uint8)
    offsets = np.r_[0, np.cumsum([len(t) + 1 for t in shard.texts])]
    offsets[-1] -= 1
    begin, end, first = word_spans(data, offsets)
    hashes = Powers().ranges(mix(data.astype(np.uint64) + np.uint64(1)), begin, end)
    numbers = np.unique(hashes, return_inverse=True)[1].astype(np.int64) + 1
    index = FMIndex([numbers[a:b] for a, b in zip(first[:-1], first[1:])])
    # Every window's end, as a position in the index's text.
    ends = [np.arange(a + window - 1, b - 1) for a, b in zip(index.starts[:-1], index.starts[1:])]
    fragment = np.repeat(np.arange(len(ends)), [len(e) for e in ends])
    at = np.concatenate(ends)
    symbol = index.text[at]
    low, high = index.smaller[symbol], index.smaller[symbol + 1]
    length = 1
    while length < window and len(at):
        more = high - low > 1
        at, fragment, low, high = at[more], fragment[more], low[more], high[more]
        low, high = index.extend(index.text[at - length], low, high)
        length += 1
    more = high - low > 1
    at, fragment, low, high = at[more] - window + 1, fragment[more], low[more], high[more]
    if not len(at):
        return []
    again = index.first_place(low, high) < at
    at, fragment = at[again], fragment[again]
    edge = np.flatnonzero(np.r_[True, (at[1:] != at[:-1] + 1) | (fragment[1:] != fragment[:-1])])
    starts = at - index.starts[fragment]
    lasts = np.r_[edge[1:], len(at)] - 1
    return [
        (int(fragment[a]), int(starts[a]), int(starts[b]) + window) for a, b in zip(edge, lasts) if len(at)
    ]


def dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    shard_words: int = SHARD_WORDS,
    carry: Sequence[str] = (),
    with_text: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: its id column, ``n_words``, ``spans``, ``kept_text``.

    A word (``[^\\x20\\x09-\\x0D]+``) goes if a window of ``window`` consecutive words covers it
    whose words also start earlier: in a document with a smaller id, or earlier in the
    same one. Windows are judged on the input. ``spans`` lists what goes as (start, end)
    in words, neighbours merged; ``kept_text`` is the other words, joined by one space.

    A null text has no words. Null ids come first. Rows with one id and different texts are
    ordered by a hash of the text; rows equal in both are one document and all get its
    result. Columns named in ``carry`` come along in a struct ``carried``, so no name can clash, and
    ``with_text`` adds the text as it came in, ``whole_text``. Words and fragments are told apart by 64-bit hashes.
    """
    rule = Rule(True, window, min(gram, window), True, shard_words, lambda shard: earlier_windows(shard, window))
    rows = keyed(docs, id_col, text_col, carry)
    joined = with_spans(rows, repeated_spans(rows, rule))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Handed on in small batches: those that come in hold 10,000 whole texts.
        for batch in (part for whole in batches for part in parted(whole, "_text")):
            counts, spans, kept = [], [], []
            for text, found in zip(batch.column("_text"), batch.column("spans")):
                words = (text.as_py() or "").encode().split()
                gone = merged(found.as_py())
                counts.append(len(words))
                spans.append([{"start": a, "end": b} for a, b in gone])
                for a, b in reversed(gone):
                    del words[a:b]
                kept.append(b" ".join(words).decode())
            pair = pa.struct([("start", pa.int32()), ("end", pa.int32())])
            extra = [batch.column("_text")] if with_text else []
            extra += [batch.column("carried")] if carry else []
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    batch.column("_hash"),
                    pa.array(counts, pa.int64()),
                    pa.array(spans, pa.list_(pair)),
                    pa.array(kept, pa.string()),
                    *extra,
                ],
                names=names,
            )

    own = T.StructType.fromDDL("n_words long, spans array<struct<start:int,end:int>>, kept_text string")
    fields = {f.name: f for f in rows.schema}
    whole = [T.StructField("whole_text", T.StringType())] if with_text else []
    carried = [fields["carried"]] if carry else []
    schema = T.StructType([fields["_id"], fields["_hash"], *own.fields, *whole, *carried])
    names = schema.fieldNames()
    out = joined.mapInArrow(freeing(run), schema)
    return out.withColumnsRenamed({"_id": id_col, "_hash": "text_hash"})
