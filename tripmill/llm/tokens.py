"""Token ids of whole Arrow columns, by the tokenizer file's own library.

A text is cut before each run of ASCII blanks, and between a letter or digit and an ASCII mark.
The tokenizers read here never have a token across such a cut, so the ids of the parts are
the ids of the whole. Each distinct part of a slice is encoded once, those of frequent parts
are remembered, and the texts' ids are gathered as arrays.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tripmill.llm.text import slices, utf8

#: Bytes of text whose distinct parts are found at once.
SLICE_BYTES = 2 << 20

#: Parts whose ids a task remembers, and the longest of them in bytes; others are encoded again
#: in each slice.
REMEMBERED = 60_000
REMEMBERED_BYTES = 64

#: Parts that are encoded as one text, and texts encoded at once: the library's results hold
#: many times the bytes of the ids.
JOINED = 64
TEXTS = 128

#: Texts on which cutting is compared with the whole: blanks of all kinds, marks, contractions.
PROBES = (
    "it's  two\n\nlines \t x don't  I'll",
    " lead and trail ",
    "a  b　 c 　d  e \u0085f\u0085 g",
    "\x1c a \x1d\x1e b\x1f \x1fc",
    "e ́x Å ΣΑΣ İ ﻿ z",
    "1 22  333 , ;; ?!\r\n\r\n\x0b\x0c end\n",
    "we're (a-b) c/d... x≠y 3.5%, e'll 'twas o'clock_ [z] 'S <b> $1",
    "漢字 \U0001f642 \U0001f642‍ üß",
    "né, où? (ça) ÉÀ: Ñu's -- ß; x×y é÷è. ÿ!",
)

#: The letters from U+00C0 to U+00FF: two bytes each, in either case and normal form.
LATIN = "".join(map(chr, sorted({*range(0xC0, 0x100)} - {0xD7, 0xF7})))


def latin(data: np.ndarray) -> np.ndarray:
    """Whether each byte is the last one of a letter in ``LATIN``."""
    found = np.zeros(len(data), bool)
    found[1:] = (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    return found


def part_starts(data: np.ndarray, offsets: np.ndarray, any_blank: bool) -> np.ndarray:
    """Where the parts of the texts begin: at each text, before a run of ASCII blanks, and
    before an ASCII mark behind an ASCII letter or digit or one of ``LATIN``.

    Unless ``any_blank``, one behind another kind of blank (or bytes that look like its end) cuts nothing.
    """
    kind = np.zeros(128, np.uint8)
    kind[33:127] = 1
    kind[[*range(48, 58), *range(65, 91), *range(97, 123)]] = 2
    kind = np.r_[kind, np.zeros(128, np.uint8)]
    table = np.zeros(256, bool)
    table[[32, 9, 10, 11, 12, 13]] = True
    open_ = table.copy()
    open_[28:32] = not any_blank
    start = np.zeros(len(data) + 1, bool)
    if len(data) > 1:
        one = data[:-1]
        cut = table[data[1:]] & ~open_[one]
        near = np.flatnonzero(cut & (one >= 0x80))
        before, last = data[np.maximum(near - 1, 0)], one[near]
        # The last two UTF-8 bytes of the blanks beyond ASCII.
        blank = (before == 0xC2) & ((last == 0x85) | (last == 0xA0))
        blank |= (before == 0x9A) & (last == 0x80)
        blank |= (before == 0x80) & (np.isin(last, (0xA8, 0xA9, 0xAF)) | (last <= 0x8A))
        blank |= (before == 0x81) & (last == 0x9F)
        cut[near[blank]] = any_blank
        kinds = kind[data]
        kinds[latin(data)] = 2
        start[1:-1] = cut | ((kinds[1:] == 1) & (kinds[:-1] == 2))
    start[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    start[len(data)] = False
    return np.flatnonzero(start)


class Encoder:
    """The ids of the tokenizer file at ``path``, special tokens not added, for a text or a column.

    A file whose tokenizer joins what is cut here raises ``ValueError``.
    """

    def __init__(self, path: str, remembered: int | None = None, slice_bytes: int | None = None) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one core's work
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.no_padding()
        self.whole.no_truncation()
        self._special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self._drops_blanks = self._ids(" \n") == [] and self._ids(" a \t") == self._ids("a")
        self._drops_case = self._ids("QX") == self._ids("qx")
        vocabulary = self.whole.get_vocab(with_added_tokens=False)
        self._bytes = np.zeros(1 + max(vocabulary.values()), np.int64)
        for token, i in vocabulary.items():
            self._bytes[i] = len(token.removesuffix("</w>"))
        # Where tokens stand for bytes, letters beyond ASCII are told apart by them as well.
        self._latin = all(self._bytes[self._ids(f"a{c}b")].sum() == 4 for c in LATIN)
        self._remembered = REMEMBERED if remembered is None else remembered
        self._slice_bytes = slice_bytes
        self._known: dict[bytes, int] = {}
        self._flat = np.zeros(1 << 16, np.uint32)
        self._start = np.zeros(1 << 12, np.int64)
        self._count = np.zeros(1 << 12, np.int64)
        self._used = 0
        for probe in PROBES:
            if self(probe) != self._ids(probe):
                raise ValueError(f"{path}: a token reaches over a cut")

    def _ids(self, text: str) -> list[int]:
        return self.whole.encode(text, add_special_tokens=False).ids

    def __call__(self, text: str) -> list[int]:
        return [int(i) for _, ids, _ in self.column(pa.array([text])) for i in ids]

    def column(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Slices of the column: first row, ids of its texts on end, and where each text's ids end.

        The ends begin with 0. A null is an empty text. A text that holds a special token's
        string is encoded in one go.
        """
        special = np.zeros(len(texts), bool)
        for content in self._special:
            special |= pc.fill_null(pc.match_substring(texts, content), False).to_numpy(zero_copy_only=False)
        for row, data, offsets in slices(texts, self._slice_bytes or SLICE_BYTES):
            if special[row : row + len(offsets) - 1].any():
                for i in range(len(offsets) - 1):
                    ids = self._ids(texts[row + i].as_py() or "")
                    yield row + i, np.array(ids, np.uint32), np.array([0, len(ids)])
                continue
            starts = part_starts(data, offsets, self._drops_blanks)
            first = np.searchsorted(starts, offsets)
            bounds = np.r_[starts, len(data)].astype(np.int64)
            if self._drops_case and len(data):
                upper = (data >= 65) & (data <= 90)
                upper[:-1] &= data[1:] < 128  # a mark that joins its letter sees the letter's case
                data = data + upper * np.uint8(32)
            if self._drops_blanks:
                solid = (data != 32) & ((data < 9) | (data > 13))
                bounds = np.r_[0, np.cumsum(solid)][bounds]
                data = data[solid]
            parts = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data)]
            ).dictionary_encode()
            place = self._places(parts.dictionary)[parts.indices.to_numpy()]
            counts = self._count[place]
            ends = np.r_[0, np.cumsum(counts)]
            at = np.arange(ends[-1]) + np.repeat(self._start[place] - ends[:-1], counts)
            yield row, self._flat[at], ends[first]

    def _places(self, parts: pa.Array) -> np.ndarray:
        """Where the ids of each part are kept; parts that are not remembered are overwritten next time."""
        known, listed = self._known, parts.to_pylist()
        place = np.array([known.get(part, -1) for part in listed], np.int64)
        new = np.flatnonzero(place < 0)
        if len(new):
            size, plain = self._kinds(parts)
            short = size <= REMEMBERED_BYTES
            # Those to be remembered come first, and of them those that can be joined.
            new = new[np.lexsort((~plain[new], ~short[new]))]
            missing = [listed[i] for i in new.tolist()]
            ids, counts = self._encoded(missing, size[new], int(np.count_nonzero(plain[new])))
            first = len(known)
            self._flat = _room(self._flat, self._used + len(ids))
            self._start = _room(self._start, first + len(new))
            self._count = _room(self._count, first + len(new))
            self._flat[self._used : self._used + len(ids)] = ids
            self._count[first : first + len(new)] = counts
            self._start[first : first + len(new)] = self._used + np.cumsum(counts) - counts
            place[new] = first + np.arange(len(new))
            stay = max(0, min(int(np.count_nonzero(short[new])), self._remembered - first))
            known.update(zip(missing[:stay], range(first, first + stay)))
            self._used += int(counts[:stay].sum())
        return place

    def _kinds(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Each part's bytes, and whether it can follow another plain one in a text that is cut between them."""
        data, ends = utf8(parts)
        size = np.diff(ends)
        wide = data >= 128
        if self._latin:
            letter = np.flatnonzero(latin(data))
            wide[letter] = wide[letter - 1] = False
        wide = np.r_[0, np.cumsum(wide)]
        plain = (size > 0) & (size <= REMEMBERED_BYTES) & (wide[ends[1:]] == wide[ends[:-1]])
        own = np.flatnonzero(plain)
        if not self._drops_blanks:
            head = data[ends[own]]
            plain[own] = (head == 32) | ((head >= 9) & (head <= 13))
        tail = data[ends[own + 1] - 1] | 32
        plain[own] &= (tail >= 128) | ((tail >= 97) & (tail <= 122))
        return size, plain

    def _encoded(self, parts: list[bytes], size: np.ndarray, plain: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the parts on end, and how many each has.

        The first ``plain`` parts are encoded many in one text: their tokens' bytes tell where each ends.
        """
        between = b" " if self._drops_blanks else b""
        texts = [between.join(parts[i : min(i + JOINED, plain)]).decode() for i in range(0, plain, JOINED)]
        texts += [part.decode() for part in parts[plain:]]
        ids = []
        for i in range(0, len(texts), TEXTS):
            found = self.whole.encode_batch_fast(texts[i : i + TEXTS], add_special_tokens=False)
            ids += [np.array(e.ids, np.uint32) for e in found]
        joined = -(-plain // JOINED)
        head = np.concatenate([np.zeros(0, np.uint32), *ids[:joined]])
        ends, last = np.cumsum(self._bytes[head]), np.cumsum(size[:plain])
        at = np.searchsorted(ends, last)
        if plain and (ends[-1] != last[-1] or (ends[at] != last).any()):
            raise ValueError("a token reaches over a cut")
        counts = np.r_[np.diff(at, prepend=-1), np.array([len(i) for i in ids[joined:]], np.int64)]
        return np.concatenate([head, *ids[joined:]]), counts


@lru_cache(maxsize=1)
def lasting(path: str, remembered: int) -> Encoder:
    """An encoder that a Python worker keeps from task to task, with the parts it remembers."""
    return Encoder(path, remembered)


def _room(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    wider = np.zeros(max(size, 2 * len(array)), array.dtype)
    wider[: len(array)] = array
    return wider


def by_column(encode: Callable[[str], list[int]], texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """What ``Encoder.column`` yields, for any function from a text to its ids."""
    if hasattr(encode, "column"):
        yield from encode.column(texts)
    else:
        for row, text in enumerate(texts):
            ids = np.array(encode(text.as_py() or ""), np.uint32)
            yield row, ids, np.array([0, len(ids)])


def with_end(ids: np.ndarray, ends: np.ndarray, end_id: int) -> tuple[bytes, np.ndarray]:
    """Little-endian ids of texts on end, each followed by ``end_id``, and where each text's ids end."""
    out = np.empty(len(ids) + len(ends) - 1, "<u4")
    ends = ends + np.arange(len(ends))
    last = np.zeros(len(out), bool)
    last[ends[1:] - 1] = True
    out[last] = end_id
    out[~last] = ids
    return out.tobytes(), ends
