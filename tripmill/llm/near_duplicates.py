"""Near-duplicate documents by a chosen-path set similarity join.

A document is the set of its word shingles. In each of several independent trees it
goes down the path that minwise tokens choose; nodes that are still large branch again by
further tokens, small ones are compared exhaustively on whole sets, and the links
confirmed there make the groups. Later trees look only for links between groups.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.components import components
from tripmill.llm.groups import by_group
from tripmill.llm.marks import marks
from tripmill.llm.scratch import written
from tripmill.llm.text import Powers, freeing, lower_ascii, mix, slices, utf8, word_spans
from tripmill.operators.conform import union_all

SHINGLE = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 85
#: A pair at similarity s is missed by all trees with probability (1 - s) ** TREES at most
#: where its nodes are small, so under one in a million at 0.85.
TREES = 8
#: Minwise tokens of a document, among which the trees choose.
TOKENS = 32
#: The trees are gone through in these groups. What the first ones link is one group by then, and
#: later ones look only for what connects different groups, so few sets are sent twice.
ROUNDS = ((0,), (1, 2), tuple(range(3, TREES)))
#: Children of a large node: a pair at 0.85 gets into one of them together with
#: probability 0.978 per level.
BRANCHES = 2
DEPTH = 3
#: Sets compared at once, and shingles in them. A larger node is compared in blocks of half
#: the size, every block with every other: one of more than ``BLOCKS`` blocks
#: branches first, and what the last level leaves is compared in however many blocks it takes.
SETS = 1024
SHINGLES = 1 << 20
BLOCKS = 8


def shingle_sets(column: pa.Array, shingle: int) -> Iterator[np.ndarray]:
    """For each text its sorted distinct shingle hashes (A-Z lower-cased).

    A text with fewer words, but not none, is one shingle.
    """
    powers, word_powers = Powers(), Powers(1)
    for _, data, offsets in slices(column):
        starts, ends, first = word_spans(data, offsets)
        words = powers.ranges(mix(lower_ascii(data).astype(np.uint64) + np.uint64(1)), starts, ends)
        begin = np.arange(max(0, len(words) - shingle + 1))
        grams = word_powers.ranges(words, begin, begin + shingle)
        for a, b in zip(first[:-1], first[1:]):
            if b - a >= shingle:
                yield np.unique(grams[a : b - shingle + 1])
            elif b > a:
                yield word_powers.ranges(words, np.array([a]), np.array([b]))
            else:
                yield np.zeros(0, np.uint64)


def set_key(grams: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    one, two = mix(grams), mix(grams ^ np.uint64(0x5851F42D4C957F2D))
    return np.array([one.sum(), two.sum() + np.uint64(len(grams))], np.uint64).tobytes()


def signatures(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """``id, hash, n, cls, tokens``: its text's hash, and size, key and minwise tokens of each document's set.

    The tokens are 32-bit words, one after another; empty where the set is.
    """
    factors = mix(np.arange(1, TOKENS + 1, dtype=np.uint64)) | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, keys, tokens = [], [], []
            for grams in shingle_sets(batch.column(1), shingle):
                n.append(len(grams))
                keys.append(set_key(grams))
                least = [((grams * f) >> np.uint64(32)).min() for f in factors] if len(grams) else []
                tokens.append(np.array(least, "<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(keys, pa.binary())]
                + [pa.array(tokens, pa.binary())],
                names=["id", "hash", "n", "cls", "tokens"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, hash long, n long, cls binary, tokens binary"
    return docs.select(F.col(id_col).alias("id"), text_col, F.xxhash64(text_col)).mapInArrow(freeing(run), schema)


def placed(classes: DataFrame, trees: Sequence[int]) -> DataFrame:
    """``node, no, n, label, sketch``: the root nodes of each class in these trees.

    The sketch has the lowest four bits of each token. Tokens that agree agree in these, so
    a partner at the threshold is never overlooked by them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = utf8(batch.column(3))
            tokens = np.frombuffer(data[ends[0] : ends[-1]].tobytes(), "<u4").reshape(-1, TOKENS)
            low = (tokens & 15).astype(np.uint8)
            sketch = low[:, ::2] | low[:, 1::2] << 4
            bounds = pa.py_buffer(np.arange(0, sketch.size + 1, sketch.shape[1]).astype(np.int64))
            sketch = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(tokens), [None, bounds, pa.py_buffer(sketch.tobytes())]
            ).cast(pa.binary())
            for tree in trees:
                node = mix(tokens[:, tree].astype(np.uint64) + (np.uint64(tree + 1) << np.uint64(32)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node.view(np.int64)), *batch.columns[:3], sketch],
                    names=["node", "no", "n", "label", "sketch"],
                )

    rows = classes.select("no", "n", "label", "tokens")
    return rows.mapInArrow(freeing(run), "node long, no long, n long, label long, sketch binary")


def leaves(classes: DataFrame, trees: Sequence[int]) -> DataFrame:
    """``node, side, no, label, sketch``: who is compared with whom.

    ``side`` is 0 in a node compared as a whole; in a pair of blocks it is 1 or 2, and only
    sets of different sides are compared. Classes with one label are connected already; a node
    that has no other is left out.
    """
    rows = written(placed(classes, trees), "nodes")
    found = []
    for level in range(DEPTH + 1):
        sizes = rows.groupBy("node").agg(
            F.count(F.lit(1)).alias("_size"),
            F.sum("n").alias("_sum"),
            (F.min("label") < F.max("label")).alias("_mixed"),
        )
        # Written first: a join of two tables is one whose hot nodes Spark can split.
        sizes = written(sizes.filter("_mixed").drop("_mixed"), "sizes")
        share = F.greatest(F.col("_size") / SETS, F.col("_sum") / SHINGLES)
        blocks = F.when(share > 1, F.ceil(2 * share)).otherwise(1).cast("int")
        sized = rows.join(sizes, "node").withColumn("_blocks", blocks)
        branches = (F.col("_blocks") > BLOCKS) & F.lit(level < DEPTH)
        found.append(written(_block_pairs(sized.filter(~branches)), "leaves"))
        rest = written(sized.filter(branches).select("node", "no", "n", "label", "sketch"), "nodes")
        if rest.isEmpty():
            break
        # Tokens are needed for these few only, so the rows above do without them.
        tokens = rest.join(classes.select("no", "tokens"), "no")
        children = F.array(*[F.struct(_child(b).alias("node")) for b in range(BRANCHES)])
        rows = written(tokens.select("no", "n", "label", "sketch", F.inline(children)), "nodes")
    all_leaves = found[0]
    for more in found[1:]:
        all_leaves = all_leaves.unionByName(more)
    return all_leaves


def _child(branch: int) -> Column:
    """The child a member of ``node`` goes to: the node's choice of token decides."""
    choice = F.pmod(F.xxhash64("node", F.lit(branch)), F.lit(TOKENS)).cast("int")
    return F.xxhash64("node", F.lit(branch), F.substring(F.col("tokens"), 4 * choice + 1, F.lit(4)))


def _block_pairs(sized: DataFrame) -> DataFrame:
    own = F.pmod(F.xxhash64("no", "node"), F.col("_blocks").cast("long")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_other")
    pairs = sized.select("node", "no", "label", "sketch", own.alias("_own"), "_blocks", other)
    low, high = F.least("_own", "_other"), F.greatest("_own", "_other")
    node = F.when(F.col("_blocks") == 1, F.col("node")).otherwise(F.xxhash64("node", low, high))
    side = F.when(low == high, 0).when(F.col("_own") == low, 1).otherwise(2)
    return pairs.select(node.alias("node"), side.alias("side"), "no", "label", "sketch")


def _runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    edges = np.flatnonzero(np.r_[True, values[1:] != values[:-1], True])
    return zip(edges[:-1].tolist(), edges[1:].tolist())


def likely(rows: DataFrame, percent: int) -> DataFrame:
    """The rows whose sketches agree with that of a partner, under another label, often enough.

    The bar lies 5.5 standard deviations below what the tokens of a pair at the threshold agree in, so
    such a pair falls below it with a probability of about one in a million.
    """
    s = percent / 100
    bar = TOKENS * max(0.0, s - 5.5 * (s * (1 - s) / TOKENS) ** 0.5)

    def run(table: pa.Table) -> pa.RecordBatch | None:
        node, side, label = (table[name].to_numpy() for name in ("node", "side", "label"))
        data, ends = utf8(table["sketch"].combine_chunks())
        packed = data[ends[0] : ends[-1]].reshape(-1, TOKENS // 2)
        sketch = np.stack([packed & 15, packed >> 4], 2).reshape(-1, TOKENS)
        keep = np.zeros(len(node), bool)
        for a, b in _runs(node):
            own, sides, labels = sketch[a:b], side[a:b], label[a:b]
            agree = np.zeros((b - a, b - a), np.uint8)
            for t in range(TOKENS):
                agree += own[:, t][:, None] == own[:, t][None, :]
            near = (agree >= bar) & ((sides[:, None] == 0) | (sides[:, None] != sides[None, :]))
            near &= labels[:, None] != labels[None, :]
            keep[a:b] = near.any(1)
        if keep.any():
            out = table.select(["node", "side", "no"]).filter(pa.array(keep)).combine_chunks()
            return out.to_batches()[0]

    return by_group(rows, ["node"], run, "node long, side int, no long")


def linked(sets: list[np.ndarray], side: np.ndarray, percent: int) -> np.ndarray:
    """Whether two sets are linked, for all pairs."""
    size = np.array([len(s) for s in sets], np.int64)
    common = np.zeros((len(sets), len(sets)), np.int64)
    if len(sets) <= 4:
        for i in range(len(sets)):
            for j in range(i):
                common[i, j] = common[j, i] = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
    else:
        row = np.repeat(np.arange(len(sets)), size)
        grams, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = np.flatnonzero(times > 1)
        number = np.full(len(grams), -1)
        number[shared] = np.arange(len(shared))
        column = number[column]
        width = max(64, (4 << 20) // len(sets))
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        for start in range(0, len(shared), width):
            a, b = np.searchsorted(column, (start, start + width))
            matrix = np.zeros((len(sets), min(width, len(shared) - start)), np.float32)
            matrix[row[a:b], column[a:b] - start] = 1
            common += np.rint(matrix @ matrix.T).astype(np.int64)
    link = 100 * common >= percent * (size[:, None] + size[None, :] - common)
    link &= (side[:, None] == 0) | (side[:, None] != side[None, :])
    np.fill_diagonal(link, False)
    return link


def forest(link: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect whatever ``link`` connects, one fewer than there are members."""
    left = np.ones(len(link), bool)
    found = []
    for root in range(len(link)):
        if not left[root]:
            continue
        left[root] = False
        stack = [root]
        while stack:
            new = np.flatnonzero(link[stack.pop()] & left)
            left[new] = False
            found.extend((root, int(x)) for x in new)
            stack.extend(new.tolist())
    return found


def links(candidates: DataFrame, docs: DataFrame, classes: DataFrame, id_col: str, text_col: str, shingle: int, percent: int) -> DataFrame:
    """``a, b``: numbers of classes linked on their whole sets, enough of them to connect each group.

    Sets are made again from the texts where these are read. Which texts are worth it is told by a
    filter of the wanted ones; what it lets through by mistake finds no candidate.
    """
    named = candidates.join(classes.select("no", "cls"), "no")
    wanted = classes.join(candidates.select("no").distinct(), "no", "left_semi")
    some = marks(wanted.select(F.xxhash64("id", "hash").alias("mark")))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).filter(pa.array(some.holds(batch.column(1).to_numpy())))
            found = list(shingle_sets(texts, shingle))
            yield pa.RecordBatch.from_arrays(
                [pa.array([set_key(s) for s in found], pa.binary()), pa.array([s.tobytes() for s in found], pa.binary())],
                names=["cls", "grams"],
            )

    texts = docs.select(text_col, F.xxhash64(id_col, F.xxhash64(text_col)).alias("mark"))
    grams = texts.mapInArrow(freeing(sets), "cls binary, grams binary").groupBy("cls").agg(F.first("grams").alias("grams"))

    def run(table: pa.Table) -> pa.RecordBatch | None:
        node, side = table["node"].to_numpy(), table["side"].to_numpy()
        a_side, b_side = [], []
        numbers, sets = table["no"].to_numpy(), table["grams"]
        for a, b in _runs(node):
            members = [np.frombuffer(sets[i].as_py(), np.uint64) for i in range(a, b)]
            for i, j in forest(linked(members, side[a:b], percent)):
                a_side.append(numbers[a + i])
                b_side.append(numbers[a + j])
        if a_side:
            return pa.RecordBatch.from_arrays([pa.array(a_side, pa.int64()), pa.array(b_side, pa.int64())], names=["a", "b"])

    full = named.join(grams, "cls").select("node", "side", "no", "grams")
    return by_group(full, ["node"], run, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """One row per row of ``docs``: its id column, ``n_shingles``, ``component_id``, ``kept``,
    ``text_hash`` and ``first``.

    Two documents are linked if 100 * intersection >= ``percent`` * union of their shingle
    sets; a component is whatever links reach, named by its smallest id, whose document is
    kept. A document of fewer words than a shingle is one shingle; one without
    words, or a null text, is linked with nothing and kept. Equal sets are one class from the start,
    so copies are never paired. Rows that repeat an id are one component if their sets
    link, and are all kept where the id is the component's. Other columns are not carried.

    ``first`` tells such rows apart by ``text_hash``, the xxhash64 of the text: in each
    component it holds for one id and text, the smallest (a null id comes last), and for
    every row without words. Only rows equal in both are left to choose from.

    Which links are looked for depends on chance with the figures at the top of this
    module; each link is confirmed on whole sets. Shingles and sets are told apart by
    64 and 128 bits.
    """
    members = written(signatures(docs, id_col, text_col, shingle), "signatures")
    classes = members.filter(F.col("n") > 0).groupBy("cls").agg(
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "hash")).alias("least"),
        F.first("n").alias("n"),
        F.first("tokens").alias("tokens"),
    )
    number = F.monotonically_increasing_id().alias("no")
    classes = written(classes.select(number, "cls", "least", "least.id", "least.hash", "n", "tokens"), "classes")
    found, labels = [], docs.sparkSession.createDataFrame([], "no long, label long")
    for trees in ROUNDS:
        labelled = classes.withColumn("label", F.col("no"))
        if found:
            labelled = classes.join(labels, "no", "left").withColumn("label", F.coalesce("label", "no"))
        candidates = written(likely(leaves(labelled, trees), percent), "candidates")
        if candidates.isEmpty():
            continue
        found.append(written(links(candidates, docs, classes, id_col, text_col, shingle, percent), "links"))
        labels = components(union_all(found)).withColumnRenamed("node", "no")
    grouped = classes.join(labels, "no")
    least = grouped.groupBy("label").agg(F.min("least").alias("component"))
    named = grouped.join(least, "label").select("cls", "component")
    alone = classes.select("cls", F.col("least").alias("own"))
    known = alone.join(named, "cls", "left").select(
        F.col("cls").alias("_cls"), F.coalesce("component", "own").alias("component")
    )
    rows = members.select("id", "hash", "n", "cls").join(known, (F.col("cls") == F.col("_cls")) & (F.col("n") > 0), "left")
    # A null id is the component's only where the component has no other.
    component = F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("component.id"))
    kept = F.col("id").eqNullSafe(component)
    return rows.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        kept.alias("kept"),
        F.col("hash").alias("text_hash"),
        (F.col("component").isNull() | (kept & (F.col("hash") == F.col("component.hash")))).alias("first"),
    )
