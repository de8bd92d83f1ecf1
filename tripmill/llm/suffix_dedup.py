"""Suffix-array dedup over bytes by merging Burrows-Wheeler transforms.

A fragment is read as symbols of ``BLOCK`` bytes aligned to its anchor, so equal windows fall
into equal symbols. Parts of a shard get a transform each; the parts' transforms are
merged by refining their interleave, one symbol of context per round, and the round in
which two neighbours first differ is their common prefix. Neighbours that agree long enough
are repeated intervals; the few bytes left over at both ends of a window are compared last.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tripmill.llm.repeats import Rule, Shard, keyed, merged, repeated_spans, with_spans
from tripmill.llm.substring_dedup import suffix_array
from tripmill.llm.text import freeing, slices

WINDOW = 400
GRAM = 16
BLOCK = 16
SHARD_BYTES = 2_000_000
#: Parts of a shard that get a transform of their own.
PARTS = 4


def transform(strings: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Transform and suffix array of ``strings`` (numbers from 1), each ended by a 0.

    Ends differ from each other, in the order of the strings. In the transform 0 stands
    before the first symbol of a string.
    """
    sizes = np.array([len(s) + 1 for s in strings])
    ends = np.cumsum(sizes) - 1
    text = np.zeros(ends[-1] + 1, np.int64)
    inside = np.ones(len(text), bool)
    inside[ends] = False
    text[inside] = np.concatenate(strings)
    distinct = text + len(strings)
    distinct[ends] = np.arange(len(strings))
    suffixes = suffix_array(distinct)
    return text[suffixes - 1], suffixes


def stable_order(symbols: np.ndarray) -> np.ndarray:
    """Stable sorting order of numbers below 2**32, by their 16-bit halves."""
    order = np.argsort(symbols.astype(np.uint16), kind="stable")
    high = (symbols >> 16).astype(np.uint16)
    return order if not high.any() else order[np.argsort(high[order], kind="stable")]


def merge(transforms: list[np.ndarray], ends: list[int], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Interleave of several transforms by their first ``depth`` symbols, and common prefixes.

    ``ends`` says how many strings each transform has. Returned are, for each merged row, the
    transform it comes from, and how many symbols it shares with the row before, ``depth`` at
    most. Every round places the row before each row, symbol by symbol, in the current
    order; so after k rounds rows are in the order of their first k symbols.
    """
    source = np.repeat(np.arange(len(transforms)), [len(t) for t in transforms])
    top = sum(ends)
    fixed = np.repeat(np.arange(len(transforms)), ends)
    shared = np.full(len(source), depth)
    group = np.zeros(len(source), np.int64)
    everything = np.concatenate(transforms)
    base = np.r_[0, np.cumsum([len(t) for t in transforms])]
    for length in range(depth):
        rows = np.empty(len(source), np.int64)
        for part in range(len(transforms)):
            rows[source == part] = np.arange(base[part], base[part + 1])
        symbols = everything[rows]
        order = stable_order(symbols)
        first = symbols[order]
        source = source[order]
        source[:top] = fixed
        group = group[order]
        new = np.ones(len(source), bool)
        new[1:] = (first[1:] != first[:-1]) | (group[1:] != group[:-1])
        new[: top + 1] = True
        shared[new & (shared == depth)] = length
        group = np.cumsum(new)
    return source, shared


def _symbols(shard: Shard, needed: int) -> tuple[list[np.ndarray], list[tuple[int, int]]]:
    """Runs of at least ``needed`` blocks that all occur twice, and (fragment, byte) of each.

    A block that occurs once cannot lie in a repeated window, so it ends a run.
    """
    blocks, places = [], []
    for i, (text, at) in enumerate(zip(shard.texts, shard.at.tolist())):
        skip = at % BLOCK
        n = (len(text) - skip) // BLOCK
        blocks.append(np.frombuffer(text, np.uint8)[skip : skip + n * BLOCK])
        places.append((i, skip, n))
    pairs = np.concatenate(blocks).view(np.uint64).reshape(-1, BLOCK // 8)
    order = np.lexsort(pairs.T)
    change = np.r_[True, (pairs[order[1:]] != pairs[order[:-1]]).any(1)]
    number = np.empty(len(pairs), np.int64)
    number[order] = np.cumsum(change)
    counts = np.bincount(number)
    often = counts > 1
    renumbered = np.cumsum(often) * often
    number = renumbered[number]
    strings, origin = [], []
    base = 0
    for i, skip, n in places:
        own = number[base : base + n]
        base += n
        edges = np.flatnonzero(np.diff(np.r_[0, (own > 0).astype(np.int8), 0]))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if b - a >= needed:
                strings.append(own[a:b])
                origin.append((i, skip + a * BLOCK))
    return strings, origin


def repeated_windows(shard: Shard, window: int) -> list[tuple[int, int, int]]:
    """Spans of windows of a shard's fragments that start at another place of it, too."""
    needed = (window - BLOCK + 1) // BLOCK  # whole blocks in a window, however it is aligned
    strings, origin = _symbols(shard, needed)
    if len(strings) < 2:
        return []
    cuts = np.linspace(0, len(strings), min(PARTS, len(strings)) + 1).astype(int)
    parts = [strings[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
    done = [transform(part) for part in parts]
    source, shared = merge([t for t, _ in done], [len(p) for p in parts], needed)
    # The string and the block in it that each merged row starts at.
    string, block = np.empty(len(source), np.int64), np.empty(len(source), np.int64)
    for number, (part, (_, suffixes)) in enumerate(zip(parts, done)):
        starts = np.r_[0, np.cumsum([len(s) + 1 for s in part])]
        which = np.searchsorted(starts, suffixes, side="right") - 1
        mine = source == number
        string[mine], block[mine] = cuts[number] + which, suffixes - starts[which]
    alike = shared >= needed
    repeated = alike | np.r_[alike[1:], False]
    group = np.cumsum(~alike)[repeated]
    string, block = string[repeated], block[repeated]
    if not len(group):
        return []
    fragment = np.array([f for f, _ in origin])[string]
    first = np.array([b for _, b in origin])[string] + block * BLOCK
    sizes = np.array([len(t) for t in shard.texts])
    bases = np.r_[0, np.cumsum(sizes)]
    data = np.frombuffer(b"".join(shard.texts), np.uint8)
    windows = []
    for left in range(BLOCK):
        right = window - left - needed * BLOCK
        begin = first - left
        whole = (begin >= 0) & (begin + window <= sizes[fragment])
        if whole.sum() < 2:
            continue
        place = bases[fragment[whole]] + begin[whole]
        key = np.empty((len(place), 8 + left + right), np.uint8)
        key[:, :8] = group[whole].astype(np.int64)[:, None].view(np.uint8)
        key[:, 8 : 8 + left] = data[place[:, None] + np.arange(left)]
        key[:, 8 + left :] = data[place[:, None] + np.arange(window - right, window)]
        keys = np.ascontiguousarray(key).view(f"V{key.shape[1]}").ravel()
        _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
        twice = counts[inverse] > 1
        windows.append(np.stack([fragment[whole][twice], begin[whole][twice]]))
    found = np.concatenate(windows, axis=1) if windows else np.zeros((2, 0), np.int64)
    found = found[:, np.lexsort(found[::-1])]
    if not found.shape[1]:
        return []
    edge = np.r_[True, (found[0, 1:] != found[0, :-1]) | (found[1, 1:] > found[1, :-1] + 1)]
    firsts = np.flatnonzero(edge)
    lasts = np.r_[firsts[1:], found.shape[1]] - 1
    return [(int(found[0, a]), int(found[1, a]), int(found[1, b]) + window) for a, b in zip(firsts, lasts)]


def dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: its id column, ``n_bytes``, ``spans``, ``kept``.

    A byte of the UTF-8 text goes if a string of ``window`` bytes covers it that also starts
    at any other place, in this document or another; overlaps count, and strings
    are judged on the input. ``spans`` lists what goes as (start, end) in bytes, neighbours
    merged; ``kept`` is the other bytes.

    A null text is empty. Rows that repeat an id and a text are one document and all get
    its result; rows with one id and different texts are different documents. Other columns are not carried.
    ``window`` must be at least twice ``BLOCK``. Fragments are told apart by 64-bit hashes.
    """
    if window < 2 * BLOCK or gram > window:
        raise ValueError(f"a window has {2 * BLOCK} bytes at least, and as many as a gram")
    rule = Rule(False, window, gram, False, shard_bytes, lambda shard: repeated_windows(shard, window))
    rows = keyed(docs, id_col, text_col)
    joined = with_spans(rows, repeated_spans(rows, rule))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, spans, kept = [], [], []
            for row, data, offsets in slices(batch.column(2)):
                for i in range(len(offsets) - 1):
                    text = data[offsets[i] : offsets[i + 1]]
                    gone = merged(batch.column(3)[row + i].as_py())
                    edges = [0, *(x for span in gone for x in span), len(text)]
                    sizes.append(len(text))
                    spans.append([{"start": a, "end": b} for a, b in gone])
                    kept.append(b"".join(text[a:b].tobytes() for a, b in zip(edges[::2], edges[1::2])))
            pair = pa.struct([("start", pa.int32()), ("end", pa.int32())])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(pair)), pa.array(kept, pa.binary())],
                names=["_id", "n_bytes", "spans", "kept"],
            )

    kind = rows.schema["_id"].dataType.simpleString()
    schema = f"_id {kind}, n_bytes long, spans array<struct<start:int,end:int>>, kept binary"
    return joined.mapInArrow(freeing(run), schema).withColumnRenamed("_id", id_col)
