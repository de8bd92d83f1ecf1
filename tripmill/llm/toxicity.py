"""Toxicity from subword-bag embeddings averaged into a linear softmax, trained in numpy.

A word is the mean of the vectors of its character n-grams (and of itself), a text the mean
of its words, and a softmax over two classes reads the text; vectors and softmax are
trained together. A misspelling shares most n-grams with the word it comes from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.llm.text import Powers, freeing, give_back, mix, refuse_taken

#: Labelled rows a model is fitted on at most; each is read whole.
MAX_ROWS = 6_000
BUCKETS = 1 << 16
DIMENSIONS = 4
EPOCHS = 10
#: A small sample is gone through more often, for so many steps.
STEPS = 300
BATCH = 64
RATE = 1.0
LONGEST = 5
#: Characters looked at together; a longer text is looked at on its own.
CHARACTERS = 1 << 17

#: Stands for both ends of a word.
_EDGE = "\x01"


def subwords(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all subwords of some texts, their share in the text, and the text's number.

    The subwords of a word, in lower case and with its ends marked, are its runs of 3 to
    ``LONGEST`` characters and the word. Each has an equal share in its word, and each word in its text.
    """
    counts, parts = [], []
    for text in texts:
        words = text.lower().replace(_EDGE, " ").split()
        counts.append(len(words))
        parts.extend(words)
    chain = f"{_EDGE}{_EDGE.join(parts)}{_EDGE}" if parts else ""
    points = np.frombuffer(chain.encode("utf-32-le", "surrogatepass"), np.uint32)
    edge = points == ord(_EDGE)
    word = np.cumsum(edge) - 1
    values = mix(points.astype(np.uint64))
    ends = np.flatnonzero(edge)
    hashes = [Powers().ranges(values, ends[:-1], ends[1:] + 1)]
    owners = [np.arange(len(parts))]
    run, broken = values, np.zeros(len(values), bool)
    for n in range(2, LONGEST + 1):
        run = run[:-1] * np.uint64(0x9E3779B97F4A7C15) + values[n - 1 :]
        broken = broken[:-1]
        if n > 2:
            broken = broken | edge[n - 2 : -1]
            whole = ~broken
            hashes.append(mix(run[whole]))
            owners.append(word[: len(run)][whole])
    owner = np.concatenate(owners)
    bucket = (np.concatenate(hashes) & np.uint64(BUCKETS - 1)).astype(np.int64)
    of_word = np.repeat(np.arange(len(texts)), counts)
    share = 1 / np.maximum(np.bincount(owner, minlength=len(parts)), 1)
    share /= np.maximum(np.array(counts), 1)[of_word]
    return bucket, share[owner], of_word[owner]


def some_texts(column: pa.Array) -> Iterator[list[str]]:
    """Consecutive texts of about ``CHARACTERS``; a null is empty."""
    held, size = [], 0
    for text in column:
        held.append(text.as_py() or "")
        size += len(held[-1])
        if size > CHARACTERS:
            yield held
            held, size = [], 0
    if held:
        yield held


@dataclass(frozen=True)
class Model:
    """``weights``: of each subword bucket, its vector times the difference of the classes."""

    weights: np.ndarray
    bias: float


def sample(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows: int
) -> DataFrame:
    """At most ``rows`` labelled texts as (label, text), chosen by a hash of the id.

    A label stands for one text: of several rows with its id, the text that sorts last. Repeated
    labels count once; an id with both labels counts for each.
    """
    keys = labels.select(F.col(id_col).alias("_key"), F.col(label_col).cast("int").alias("_label"))
    keys = keys.filter(F.col("_label").isin(0, 1)).distinct().orderBy(F.xxhash64("_key"), "_key", "_label").limit(rows)
    texts = docs.select(F.col(id_col).alias("_key"), F.col(text_col).alias("_text"))
    labelled = texts.join(F.broadcast(keys), "_key").groupBy("_key", "_label")
    return labelled.agg(F.max("_text").alias("_text"))


def fit(bags: list[tuple[int, np.ndarray, np.ndarray]], seed: int = 1) -> Model:
    """Train on (label, subword buckets, their share of the text), by mini-batch AdaGrad.

    Without both classes the model is even. The same bags give the same model.
    """
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.01, (BUCKETS, DIMENSIONS)).astype(np.float32)
    output = rng.normal(0, DIMENSIONS**-0.5, (DIMENSIONS, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    bags = [bag for bag in bags if len(bag[1])]
    label = np.array([bag[0] for bag in bags], np.int64)
    if len(set(label.tolist())) < 2:
        return Model(np.zeros(BUCKETS, np.float32), 0.0)
    seen_vectors = np.full(BUCKETS, 1e-8, np.float32)
    seen_output, seen_bias = np.full(output.shape, 1e-6, np.float32), np.full(2, 1e-6, np.float32)
    epochs = max(EPOCHS, -(-STEPS * BATCH // len(bags)))
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        for some in np.array_split(rng.permutation(len(bags)), max(1, len(bags) // BATCH)):
            sizes = [len(bags[i][1]) for i in some]
            buckets = np.concatenate([bags[i][1] for i in some])
            share = np.concatenate([bags[i][2] for i in some])[:, None]
            text = np.add.reduceat(vectors[buckets] * share, np.r_[0, np.cumsum(sizes)[:-1]])
            logits = text @ output + bias
            error = np.exp(logits - logits.max(1, keepdims=True))
            error /= error.sum(1, keepdims=True)
            error[np.arange(len(some)), label[some]] -= 1
            back = np.repeat(error @ output.T, sizes, axis=0) * share
            for values, seen, step in (
                (output, seen_output, text.T @ error / len(some)),
                (bias, seen_bias, error.mean(0)),
            ):
                seen += step**2
                values -= rate * step / np.sqrt(seen)
            step = np.stack([np.bincount(buckets, b, BUCKETS) for b in back.T], 1).astype(np.float32)
            seen_vectors += (step**2).mean(1)
            vectors -= rate * step / np.sqrt(seen_vectors)[:, None]
    return Model(vectors @ (output[:, 1] - output[:, 0]), float(bias[1] - bias[0]))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_rows: int = MAX_ROWS,
) -> Model:
    """Fit a model on at most ``max_rows`` labelled texts.

    The bags of subwords are made on the executors; each is bounded by the number of
    buckets, so what the driver holds is bounded by ``max_rows``. Labels other than 0 and 1
    are left out; a null text is an empty bag and teaches the bias alone.
    """
    chosen = sample(docs, labels, id_col, text_col, label_col, max_rows)

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = 0
            for texts in some_texts(batch.column(1)):
                bucket, share, owner = subwords(texts)
                cells, which = np.unique(owner * BUCKETS + bucket, return_inverse=True)
                total = np.bincount(which, share).astype("<f4")
                cuts = np.searchsorted(cells, np.arange(len(texts) + 1) * BUCKETS).tolist()
                own = (cells % BUCKETS).astype("<u2")
                spans = list(zip(cuts[:-1], cuts[1:]))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, len(texts)),
                        pa.array([own[x:y].tobytes() for x, y in spans], pa.binary()),
                        pa.array([total[x:y].tobytes() for x, y in spans], pa.binary()),
                    ],
                    names=["label", "buckets", "shares"],
                )
                row += len(texts)

    rows = chosen.select("_label", "_text").mapInArrow(freeing(bags), "label int, buckets binary, shares binary").toArrow()
    # However the rows arrived, the model is the same.
    order = sorted(zip(*(rows[name].to_pylist() for name in ("label", "buckets", "shares"))))
    del rows
    model = fit([(y, np.frombuffer(b, "<u2"), np.frombuffer(w, "<f4")) for y, b, w in order])
    del order
    give_back()
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with ``toxicity``, from 0 to 1; a null text counts as empty.

    A table that has such a column is refused.
    The average of a text is linear in its subwords, so each bucket is one number. The model has a fixed size (``BUCKETS`` numbers) and travels with the task.
    """
    refuse_taken(docs, "toxicity")
    schema = T.StructType([*docs.schema.fields, T.StructField("toxicity", T.DoubleType())])
    at = docs.columns.index(text_col)
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = 0
            for texts in some_texts(batch.column(at)):
                bucket, share, owner = subwords(texts)
                logits = np.bincount(owner, model.weights[bucket] * share, len(texts)) + model.bias
                scores = 1 / (1 + np.exp(-np.clip(logits, -700, 700)))
                # Handed on in small batches: those that come in hold 10,000 whole texts.
                some = batch.slice(row, len(texts))
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(scores)], names=names)
                row += len(texts)

    return docs.mapInArrow(freeing(run), schema)
