"""Ranked lexical search over bag classes, against brute force."""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
import pytest
from llm_cases import LOWER, awkward, prose
from pyspark.sql import functions as F

from tripmill.llm import lexical, queries

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute(docs, items, top=10):
    bags = [(i, Counter(terms(text))) for i, text in docs]
    n_docs = sum(1 for _, bag in bags if bag)
    total = sum(sum(bag.values()) for _, bag in bags)
    merged = {}
    for item, text in items:
        merged.setdefault(item, set()).update(terms(text))
    df = Counter(t for _, bag in bags for t in bag)
    found = []
    for item, wanted in merged.items():
        ranked = []
        for i, bag in bags:
            m = 100 - 90 + (90 * sum(bag.values()) * n_docs) // total if total else 0
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m))
                for t in wanted
                if t in bag
            )
            if score > 0:
                ranked.append((-score, i is None, i or 0, i))
        for rank, (score, _, _, i) in enumerate(sorted(ranked, key=lambda r: r[:3])[:top], 1):
            found.append((item, rank, i, -score))
    return found


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is not None, str(r[0]), r[1]))


@pytest.fixture()
def items_of(spark):
    def make(rows):
        return spark.createDataFrame([(*r, 5, "x") for r in rows], "item_id long, text string, score int, doc_id string")

    return make


DOCS = [
    *awkward(),
    *[(1000 + i, prose(20 + i % 9, 60)) for i in range(60)],
    *[(500 - i, "Ties w1, w1! TIES") for i in range(40)],
    (2000, "ÉTÉ été Été x_y foo-bar 3.14 a’b 漢字kana"),
    (2001, "été foo"),
]
ITEMS = [
    (0, prose(1, 40)),
    (1, "ties W1"),
    (2, None),
    (3, ""),
    (4, "nowhere at all zzz"),
    (5, "ÉTÉ été foo x 14 漢字kana"),
    (6, prose(25, 30) + " " + prose(4, 200)),
    (7, "w3 w4"),
    (7, "w5 w3"),
    (1, "ties W1"),
    (None, "w7"),
    (None, "w8"),
]


@pytest.mark.parametrize(("parts", "cells", "block"), [(1, 1 << 21, 1 << 24), (7, 1 << 21, 1 << 24), (4, 50, 1 << 24), (3, 1 << 12, 300)])
def test_search_is_brute_force(docs_of, items_of, monkeypatch, parts, cells, block):
    monkeypatch.setattr(lexical, "CELLS", cells)
    monkeypatch.setattr(lexical, "BLOCK_BYTES", block)
    monkeypatch.setattr(lexical, "SLICE_BYTES", 2000)
    found = lexical.search(docs_of(DOCS).repartition(parts), items_of(ITEMS))
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert order(found.collect()) == order(brute(DOCS, ITEMS))


@pytest.mark.parametrize("top", [1, 3])
def test_fewer_places(docs_of, items_of, top):
    found = lexical.search(docs_of(DOCS).repartition(3), items_of(ITEMS), top=top)
    assert order(found.collect()) == order(brute(DOCS, ITEMS, top))


def test_a_hot_bag_is_one_class(docs_of, items_of, shared):
    rows = [(i, "Same bag, bag same!") for i in range(900)] + [(i, f"same {i}") for i in range(5000, 5030)]
    found = lexical.search(docs_of(rows).repartition(6), items_of([(1, "bag same")]))
    assert [r.doc_id for r in found.orderBy("rank").collect()] == list(range(10))
    # The query's terms are all that counts: "same 5000" and "same 5001" are one class as well.
    bag = lexical.bags(docs_of(rows), pa.array([b"bag", b"same"], pa.large_binary()), "doc_id", "text")
    assert lexical.classes(bag, 930, 930 * 3, 10).count() == 2


def test_nothing_to_search(docs_of, items_of):
    empty = docs_of([])
    assert lexical.search(empty, items_of(ITEMS)).count() == 0
    assert lexical.search(docs_of([(1, None), (2, " .,")]), items_of(ITEMS)).count() == 0
    for items in ([], [(1, None)], [(1, "...")]):
        assert lexical.search(docs_of(DOCS), items_of(items)).count() == 0
    with pytest.raises(ValueError, match="names of their own"):
        lexical.search(empty, items_of(ITEMS), item_col="score")


def test_an_item_longer_than_a_block_is_searched_whole(docs_of, items_of, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_BYTES", 64)
    items = [(1, prose(4, 3000)), (2, "w1"), (3, prose(5, 500))]
    found = lexical.search(docs_of(awkward()), items_of(items))
    assert order(found.collect()) == order(brute(awkward(), items))


def test_query_agrees_with_sql(spark, sf_dir, shared):
    import duckdb

    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    want = con.execute(queries.oracle_sql()["op11_bag_search"]).fetchall()
    found = queries.op11_bag_search(spark, sf_dir).select("item_id", "rank", "doc_id", "score")
    assert order(found.collect()) == order(want)
    assert found.groupBy("item_id").agg(F.count("rank")).count() > 10
