"""Substring, suffix and near-duplicate dedup against brute force."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_cases import awkward, lowered, prose, words
from tripmill.llm import near_duplicates, queries, repeats, substring_dedup, suffix_dedup
from tripmill.llm.components import components


def key(i):
    return (i is not None, i or 0)


def brute_words(rows, window):
    """(id, n_words, removed, kept text) of each row; rows equal in id and text are one."""
    seen, out = set(), {}
    for i, text in sorted(set(rows), key=lambda r: (key(r[0]), r[1] or "")):
        w = words(text)
        gone = np.zeros(len(w), bool)
        for j in range(len(w) - window + 1):
            part = tuple(w[j : j + window])
            if part in seen:
                gone[j : j + window] = True
            seen.add(part)
        out[i, text] = (len(w), int(gone.sum()), b" ".join(x for x, g in zip(w, gone) if not g).decode())
    return sorted(((i, *out[i, t]) for i, t in rows), key=lambda r: (key(r[0]), r[1:]))


@pytest.mark.parametrize(("hot", "rows_of_one"), [(256, 1000), (1, 1000), (256, 3)])
def test_substring_dedup_is_brute_force(docs_of, monkeypatch, hot, rows_of_one):
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "HOT_ROWS", rows_of_one)
    rows = awkward() + [(20 + i, prose(40 + i, 30) + " " + prose(9, 25) + " " + prose(80 + i, 30)) for i in range(12)]
    found = substring_dedup.dedup(docs_of(rows), shard_words=400)
    found = found.withColumn("n", F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["start"]))
    got = [(r.doc_id, r.n_words, r.n, r.kept_text) for r in found.collect()]
    assert sorted(got, key=lambda r: (key(r[0]), r[1:])) == brute_words(rows, 20)


def test_substring_dedup_of_nothing(docs_of):
    assert substring_dedup.dedup(docs_of([])).count() == 0


def test_carried_columns_come_along(docs_of):
    rows = docs_of(awkward())
    found = substring_dedup.dedup(rows, carry=rows.columns, with_text=True)
    assert found.filter("NOT whole_text <=> carried.text").isEmpty()
    assert sorted(map(str, found.select("carried.*").collect())) == sorted(map(str, rows.collect()))


@pytest.mark.parametrize("seed", range(4))
def test_fm_index_counts_and_finds(seed):
    rng = np.random.default_rng(seed)
    texts = [rng.integers(1, 6, rng.integers(1, 40)) for _ in range(6)]
    index = substring_dedup.FMIndex(texts)
    joined = index.text
    for size in (1, 2, 3, 5):
        pattern = rng.integers(1, 6, size)
        low, high = np.array([index.smaller[pattern[-1]]]), np.array([index.smaller[pattern[-1] + 1]])
        for symbol in pattern[-2::-1]:
            low, high = index.extend(np.array([symbol]), low, high)
        places = [i for i in range(len(joined) - size + 1) if (joined[i : i + size] == pattern).all()]
        assert int(high[0] - low[0]) == len(places)
        if places:
            assert index.first_place(low, high)[0] == places[0]


@pytest.mark.parametrize("seed", range(4))
def test_merged_transforms_are_the_transform_of_all(seed):
    rng = np.random.default_rng(seed)
    strings = [rng.integers(1, 4, rng.integers(1, 30)) for _ in range(9)]
    parts = [strings[:2], strings[2:5], strings[5:]]
    depth = 40
    transforms = [suffix_dedup.transform(p) for p in parts]
    source, shared = suffix_dedup.merge([t for t, _ in transforms], [len(p) for p in parts], depth)
    rows = {}
    for number, part in enumerate(parts):
        text = [x for s in part for x in [*s.tolist(), 0]]
        rows[number] = iter([text[i:] for i in transforms[number][1].tolist()])
    suffixes = [next(rows[s]) for s in source.tolist()]
    cut = [s[: s.index(0)] for s in suffixes]
    assert cut == sorted(cut)
    for before, after, n in zip(cut, cut[1:], shared[1:]):
        same = 0
        while same < min(len(before), len(after)) and before[same] == after[same]:
            same += 1
        assert n == same


def brute_bytes(rows, window):
    texts = {r: (r[1] or "").encode() for r in set(rows)}
    starts = Counter(t[i : i + window] for t in texts.values() for i in range(len(t) - window + 1))
    out = {}
    for row, t in texts.items():
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - window + 1):
            if starts[t[i : i + window]] > 1:
                gone[i : i + window] = True
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        out[row] = (len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return sorted(((r[0], *out[r]) for r in rows), key=lambda r: (key(r[0]), r[1:]))


@pytest.mark.parametrize(("hot", "window"), [(256, 400), (256, 101), (1, 100)])
def test_suffix_dedup_is_brute_force(docs_of, monkeypatch, hot, window):
    monkeypatch.setattr(repeats, "HOT", hot)
    rows = [r for r in awkward() if len(r[1] or "") < 50_000]
    rows += [(20 + i, prose(40 + i, 30) + " " + prose(9, 90) + " " + prose(80 + i, 30)) for i in range(12)]
    found = suffix_dedup.dedup(docs_of(rows), window=window, shard_bytes=3000)
    found = found.withColumn("n", F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["start"]))
    got = [(r.doc_id, r.n_bytes, r.n, len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in found.collect()]
    assert sorted(got, key=lambda r: (key(r[0]), r[1:])) == brute_bytes(rows, window)


def test_suffix_dedup_of_nothing(docs_of):
    assert suffix_dedup.dedup(docs_of([])).count() == 0


def brute_groups(rows, percent):
    sets = []
    for _, text in rows:
        w = lowered(text)
        sets.append({tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} - {()})
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
    least = {}
    for (i, _), g in zip(rows, label):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    return sorted(((i, len(s), least.get(g)) for (i, _), s, g in zip(rows, sets, label)), key=str)


def edited(base, changes, seed):
    w = base.split()
    rng = np.random.default_rng(seed)
    for at in rng.choice(len(w), changes, replace=False):
        w[at] = f"e{seed}x{at}"
    return " ".join(w)


@pytest.mark.parametrize(("size", "depth"), [(512, 3), (8, 1)])
def test_near_duplicates_are_brute_force(docs_of, monkeypatch, size, depth):
    monkeypatch.setattr(near_duplicates, "SETS", size)
    monkeypatch.setattr(near_duplicates, "DEPTH", depth)
    monkeypatch.setattr(near_duplicates, "BLOCKS", 2)
    base = prose(31, 220)
    rows = awkward() + [(100 + i, edited(base, 1 + i % 5, i)) for i in range(40)]
    found = near_duplicates.near_duplicates(docs_of(rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str) == brute_groups(rows, 85)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_near_duplicates_of_nothing(docs_of):
    assert near_duplicates.near_duplicates(docs_of([])).count() == 0
    assert near_duplicates.near_duplicates(docs_of([(1, None), (2, "")])).count() == 2


def test_components_of_a_path_and_a_star(spark, shared):
    path = [(f"p{i:02}".encode(), f"p{i + 1:02}".encode()) for i in range(30)]
    star = [(b"a", f"s{i}".encode()) for i in range(20)]
    links = spark.createDataFrame([(bytearray(a), bytearray(b)) for a, b in path + star], "a binary, b binary")
    found = {bytes(r.node): bytes(r.label) for r in components(links).collect()}
    assert found == {x: b"p00" for p in path for x in p} | {x: b"a" for p in star for x in p}


def test_queries_agree_with_brute_force(spark, sf_dir, shared):
    rows = [(r.doc_id, r.text) for r in queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    got = sorted(tuple(r)[:4] for r in queries.op1_substring_dedup(spark, sf_dir).collect())
    assert got == [
        (i, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, n, gone, kept in brute_words(rows, 20)
    ]
    assert sorted(tuple(r) for r in queries.op6_suffix_dedup(spark, sf_dir).collect()) == brute_bytes(rows, 400)
    found = queries.op8_near_duplicates(spark, sf_dir).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str) == brute_groups(rows, 85)
