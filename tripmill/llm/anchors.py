"""Text cut into fragments so that equal windows always land in the same place.

Of every window of consecutive symbols (words or bytes), the smallest hash of its runs of
``gram`` symbols, leftmost on ties, is the anchor. Equal windows have equal anchors, so
fragments (runs of windows with one anchor) can be dealt out by anchor: a shard then holds
every occurrence of its windows, and shards never need to meet.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from tripmill.llm.text import Powers, mix, rolling

_POSITION = np.uint64((1 << 24) - 1)


@dataclass
class Fragments:
    """Fragments of the texts of one slice; positions count symbols from the slice's start."""

    text: np.ndarray  # which text
    start: np.ndarray
    end: np.ndarray
    anchor_at: np.ndarray
    anchor: np.ndarray  # the anchor's hash
    content: np.ndarray  # a hash of the fragment's symbols


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, from block-wise running minima."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    grid = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def fragments(values: np.ndarray, offsets: np.ndarray, window: int, gram: int, powers: Powers) -> Fragments:
    """Fragments of texts whose symbols are ``values[offsets[i]:offsets[i + 1]]``.

    Texts shorter than a window have none. All windows of a fragment hold its anchor, so it is
    shorter than two windows.
    """
    empty = np.zeros(0, np.int64)
    n = len(values) - window + 1
    if n <= 0:
        return Fragments(empty, empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64))
    hashes = rolling(values, gram)
    width = window - gram + 1
    least = np.empty(n, np.int64)
    step = int(_POSITION) - width
    for start in range(0, n, step):  # positions have 24 bits
        part = hashes[start : start + step + width - 1]
        marked = (mix(part) & ~_POSITION) | np.arange(len(part), dtype=np.uint64)
        found = _sliding_min(marked, width)
        least[start : start + len(found)] = start + (found & _POSITION).astype(np.int64)
    inside = np.zeros(n, bool)
    first = np.zeros(n, bool)
    for a, b in zip(offsets[:-1], np.maximum(offsets[1:] - window + 1, offsets[:-1])):
        inside[a:b] = True
        if a < b:
            first[a] = True
    change = first.copy()
    change[1:] |= (least[1:] != least[:-1]) | (inside[1:] & ~inside[:-1])
    change[0] = True
    begin = np.flatnonzero(change & inside)
    stop = np.zeros(n + 1, bool)
    stop[1:n] = change[1:] | ~inside[1:]
    stop[n] = True
    after = np.flatnonzero(stop)
    end = after[np.searchsorted(after, begin, side="right")] + window - 1
    at = least[begin]
    return Fragments(
        np.searchsorted(offsets, begin, side="right") - 1, begin, end, at, mix(hashes[at]), powers.ranges(values, begin, end)
    )
