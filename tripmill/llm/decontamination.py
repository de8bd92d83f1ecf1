"""Benchmark decontamination by winnowing, in DataFrame functions only.

Of every window of ``window`` words, the smallest hash of its runs of ``gram`` words is the
fingerprint; documents and items that share a window share its fingerprint. Documents are
joined with the benchmark on fingerprints first; only those that share one are read again,
and a hit is a window whose words are equal. Neighbouring hits extend one another.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.scratch import written

WINDOW = 10
GRAM = 6

#: Distinct benchmark windows up to which they are broadcast; beyond, both sides shuffle.
BROADCAST_ROWS = 200_000

# What separates words, before and after A-Z are lower-cased.
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; a null has none."""
    lowered = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    found = F.regexp_extract_all(lowered, F.lit(_WORD), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_ANY_CASE_WORD)), F.lit(0))


def _starts(n: Column) -> Column:
    """0 .. n-1, or nothing."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _gram_hashes(tokens: str, gram: int) -> Column:
    return F.transform(
        _starts(F.size(tokens) - gram + 1), lambda i: F.xxhash64(F.slice(F.col(tokens), i + 1, gram))
    )


def _fingerprint(hashes: str, start: Column, grams: int) -> Column:
    if grams == 1:
        return F.get(F.col(hashes), start)
    return F.least(*[F.get(F.col(hashes), start + j) for j in range(grams)])


def _windows(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """``texts`` (with ``_words``) once for each window: ``_start, _print, _window``."""
    hashed = texts.withColumn("_hashes", _gram_hashes("_words", gram))
    found = F.transform(
        _starts(F.size("_words") - length + 1),
        lambda i: F.struct(
            i.alias("_start"),
            _fingerprint("_hashes", i, length - gram + 1).alias("_print"),
            F.array_join(F.slice(F.col("_words"), i + 1, length), " ").alias("_window"),
        ),
    )
    return hashed.select(*[c for c in texts.columns if c != "_words"], F.inline(found))


def _prints(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """``texts`` (with ``_words``) once for each distinct fingerprint ``_print``."""
    hashed = texts.withColumn("_hashes", _gram_hashes("_words", gram))
    found = F.transform(
        _starts(F.size("_words") - length + 1),
        lambda i: _fingerprint("_hashes", i, length - gram + 1),
    )
    return hashed.select(
        *[c for c in texts.columns if c != "_words"], F.explode(F.array_distinct(found)).alias("_print")
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """The rows of ``docs`` (id and text) with ``n_words``, ``hits`` and ``items``.

    A window is ``window`` consecutive words of an item; an item of fewer words, but not
    none, is one window. ``hits`` lists the spans of words, as (start, end) with the end
    left out, that windows cover, neighbours merged; ``items`` lists, sorted as strings,
    the ids of items with a window in the document. Null texts have no words; a document
    without hits has empty lists. Repeated rows each get a row. With an empty
    benchmark nothing is hit. A null item id is not listed, but its windows hit.
    """
    items = benchmark.select(
        F.col(item_col).cast("string").alias("_item"), words(F.col(item_text_col)).alias("_words")
    ).filter(F.size("_words") > 0)
    short = items.filter(F.size("_words") < window).select(F.size("_words").alias("n"))
    lengths = sorted({window, *(row.n for row in short.distinct().collect())})
    keyed = docs.select(
        F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.xxhash64(F.col(text_col)).alias("_hash")
    )
    key = ["_id", "_hash"]
    per_length = []
    for length in lengths:
        own = items if length == window else items.filter(F.size("_words") == length)
        size = min(gram, length) if length == window else length
        wanted = (
            _windows(own, length, size)
            .groupBy("_print", "_window")
            .agg(F.collect_set("_item").alias("_items"))
        )
        wanted = written(wanted, "windows")
        small = wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
        side = F.broadcast if small else (lambda frame: frame)
        prints = side(wanted.select("_print").distinct())
        tokens = keyed.select(*key, words(F.col("_text")).alias("_words"))
        suspects = _prints(tokens, length, size).join(prints, "_print", "left_semi")
        suspects = written(suspects.select(*key).distinct(), "suspects")
        again = keyed.join(suspects, _same(keyed, suspects, key), "left_semi")
        again = again.select(*key, words(F.col("_text")).alias("_words"))
        per_length.append(
            _windows(again, length, size)
            .join(side(wanted), ["_print", "_window"])
            .select(*key, F.struct("_start", (F.col("_start") + length).alias("_end")).alias("_span"), "_items")
        )
    hits = per_length[0]
    for more in per_length[1:]:
        hits = hits.unionByName(more)
    found = hits.groupBy(*key).agg(
        F.array_sort(F.collect_set("_span")).alias("_spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("_items")))).alias("items"),
    )
    found = written(found.select(*key, _merged("_spans").alias("hits"), "items"), "hits")
    rows = keyed.select(*key, word_count(F.col("_text")).alias("n_words"))
    joined = rows.join(found, _same(rows, found, key), "left").select(
        rows["_id"].alias(id_col), rows["_hash"].alias("text_hash"), "n_words", "hits", "items"
    )
    return joined.withColumns(
        {
            "hits": F.coalesce("hits", F.array().cast("array<struct<start:int,end:int>>")),
            "items": F.coalesce("items", F.array().cast("array<string>")),
        }
    )


def _same(left: DataFrame, right: DataFrame, key: list[str]) -> Column:
    first, second = key
    return left[first].eqNullSafe(right[first]) & left[second].eqNullSafe(right[second])


def _merged(spans: str) -> Column:
    """Sorted spans, those that touch or overlap made one."""
    pair = "struct<start:int,end:int>"

    def add(done: Column, span: Column) -> Column:
        last = F.element_at(done, -1)
        touching = (F.size(done) > 0) & (span["_start"] <= F.try_element_at(done, F.lit(-1))["end"])
        new = F.struct(span["_start"].alias("start"), span["_end"].alias("end"))
        wider = F.struct(
            F.try_element_at(done, F.lit(-1))["start"].alias("start"),
            F.greatest(F.try_element_at(done, F.lit(-1))["end"], span["_end"]).alias("end"),
        )
        return F.when(
            touching,
            F.concat(F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))), F.array(wider)),
        ).otherwise(F.concat(done, F.array(new)))

    return F.aggregate(F.col(spans), F.array().cast(f"array<{pair}>"), add)
