"""Fill-in-the-middle transformation assembled by secondary sorts.

A document is cut into units, and the units between its cuts into pieces of bounded length, each
keyed by its document and its position in the output. One shuffle brings a document's pieces
together, sorted by position, so that its output streams through a digest piece by piece. The
pieces read off that output, the marks that part it and its form alone, are then sorted by
their position in the original inside the same tasks, and the restored text streams through a second
digest.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The marks before prefix, middle and suffix.
PREFIX, MIDDLE, SUFFIX = "<P>", "<M>", "<S>"

#: The order of the sections in the output; in the original it is prefix, middle, suffix.
FORMS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
PLACE = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}

#: Bytes of text that a sort is meant to hold, and the most sorts side by side; beyond these, and
#: with uneven documents, sorts spill.
SORT_BYTES = 64 << 20
MAX_SORTS = 40_000

#: Units in a piece, and characters whose units are told apart at once.
PIECE_UNITS = 4096
BLOCK_CHARS = 1 << 20


def draws(doc_id: object) -> list[int]:
    """Four 32-bit numbers that a document's id fixes; a null id draws as an empty one."""
    found = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(found[8 * i : 8 * i + 8], 16) for i in range(4)]


def unit_starts(text: str) -> Iterator[np.ndarray]:
    """Where the units ``[A-Za-z]+|[^A-Za-z]`` of the text begin, block by block."""
    before = False
    for low in range(0, len(text), BLOCK_CHARS):
        code = np.frombuffer(text[low : low + BLOCK_CHARS].encode("utf-32-le"), "<u4") | 32
        letter = (code >= 97) & (code <= 122)
        yield low + np.flatnonzero(~(letter & np.r_[before, letter[:-1]]))
        before = bool(letter[-1])


def places(text: str, units: np.ndarray) -> np.ndarray:
    """Where the units of these ascending numbers begin; one past the last begins at the end."""
    found, seen = np.full(len(units), len(text)), 0
    for starts in unit_starts(text):
        low, high = np.searchsorted(units, (seen, seen + len(starts)))
        found[low:high] = starts[units[low:high] - seen]
        seen += len(starts)
    return found


def form_of(doc_id: object, text: str) -> str:
    _, _, three, four = draws(doc_id)
    if not text or any(mark in text for mark in PLACE) or three % 100 >= 90:
        return "plain"
    return "spm" if four % 100 < 20 else "psm"


def cuts(doc_id: object, units: int) -> tuple[int, int]:
    """Units before the middle, and before the suffix."""
    one, two, _, _ = draws(doc_id)
    return tuple(sorted((one % (units + 1), two % (units + 1))))


def pieces(doc_id: object, text: str) -> Iterator[tuple | bytes]:
    """The document's facts, then its output in pieces: what ``PIECE_UNITS`` units hold, marks apart."""
    n = sum(map(len, unit_starts(text)))
    form = form_of(doc_id, text)
    low, high = (0, n) if form == "plain" else cuts(doc_id, n)
    spans = {PREFIX: (0, low), MIDDLE: (low, high), SUFFIX: (high, n)}
    units = np.concatenate([np.r_[np.arange(a, b, PIECE_UNITS), b] for a, b in spans.values()])
    at = dict(zip(units.tolist(), places(text, units).tolist()))
    if form == "plain":
        yield doc_id, n, form, None, None
    else:
        yield doc_id, n, form, at[low], at[high] - at[low]
    for mark in FORMS.get(form, PLACE):
        if form != "plain":
            yield mark.encode()
        a, b = spans[mark]
        for unit in range(a, b, PIECE_UNITS):
            yield text[at[unit] : at[min(unit + PIECE_UNITS, b)]].encode()


def sections(form: str, output: Iterator[bytes]) -> Iterator[tuple[int, bytes]]:
    """Pieces of an output with the place, in the original, of the section each belongs to.

    Only the form and the output's text are read. A text that holds a mark is never cut, so
    in any other form the marks found are those put in; one is whole within a piece.
    """
    if form == "plain":
        yield from ((0, piece) for piece in output)
        return
    marks = re.compile(b"(" + b"|".join(re.escape(mark.encode()) for mark in PLACE) + b")")
    place = None
    for piece in output:
        for part in marks.split(piece):
            if marks.fullmatch(part):
                place = PLACE[part.decode()]
            elif part:
                yield place, part


def sorts(docs: DataFrame, text_col: str) -> int:
    """How many tasks sort pieces: a shuffle of rows that Python made is not resized at run time."""
    held = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    wanted = min(MAX_SORTS, -(-held // SORT_BYTES))
    return max(wanted, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id column, ``n, form, prefix_chars, middle_chars, output_sha256,
    restored_sha256``.

    A text has ``n`` units: runs of ASCII letters, and any other character on its own. What is
    prefix, middle and suffix, and the form, follow from the id (``draws``); the output of an
    empty text, of one that holds a mark, and of the share left alone is the text (``plain``; no
    lengths). A null text is an empty one. Rows that repeat an id, null among them, are transformed
    alike, each on its own. An empty table gives an empty result. Other columns are not
    carried; an id column named like a column of the result is refused.

    Rows equal in id and text are numbered within the task that reads them, and a piece's key is a
    hash of id, text, task and number: copies spread over all tasks, and a task that runs
    again yields the same pieces whatever the order of its rows.
    """
    if id_col in ("n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"):
        raise ValueError(f"the id column may not be named {id_col}")
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    parts = sorts(docs, text_col)

    def cut(task: int, rows: Iterator) -> Iterator[tuple]:
        copies = Counter()
        for doc_id, text in rows:
            own = hashlib.blake2b(f"{doc_id!r}\0{task}\0".encode(), digest_size=16)
            own.update(text.encode())
            copies[own.digest()] += 1
            own.update(copies[own.digest()].to_bytes(8))
            key = own.digest()
            for position, piece in enumerate(pieces(doc_id, text)):
                yield (key, position), piece

    def assembled(rows: Iterator[tuple]) -> Iterator[tuple]:
        for key, own in documents(rows):
            (_, facts) = next(own)
            digest = hashlib.sha256()

            def output() -> Iterator[bytes]:
                for _, piece in own:
                    digest.update(piece)
                    yield piece

            count = Counter()
            for place, piece in sections(facts[2], output()):
                count[place] += 1
                yield (key, (place, count[place])), piece
            yield (key, (-1, 0)), (*facts, digest.hexdigest())

    def restored(rows: Iterator[tuple]) -> Iterator[tuple]:
        for _, own in documents(rows):
            (_, facts) = next(own)
            digest = hashlib.sha256()
            for _, piece in own:
                digest.update(piece)
            yield (*facts, digest.hexdigest())

    sort = {"numPartitions": parts, "partitionFunc": owner}
    by_output = rows.rdd.mapPartitionsWithIndex(cut).repartitionAndSortWithinPartitions(**sort)
    # Dealt out as before, so the second sort moves nothing.
    by_place = by_output.mapPartitions(assembled, preservesPartitioning=True).repartitionAndSortWithinPartitions(**sort)
    schema = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("n", T.LongType()),
            T.StructField("form", T.StringType()),
            T.StructField("prefix_chars", T.LongType()),
            T.StructField("middle_chars", T.LongType()),
            T.StructField("output_sha256", T.StringType()),
            T.StructField("restored_sha256", T.StringType()),
        ]
    )
    return docs.sparkSession.createDataFrame(by_place.mapPartitions(restored), schema, verifySchema=False)


def owner(key: tuple) -> int:
    """A number that tells which task a piece's document belongs to."""
    return int.from_bytes(key[0][:7])


def documents(rows: Iterator[tuple]) -> Iterator[tuple[bytes, Iterator]]:
    """Runs of sorted ((document, position), piece) rows with one document each."""
    return groupby(rows, key=lambda row: row[0][0])
