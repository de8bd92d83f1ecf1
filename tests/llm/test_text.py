"""Array helpers, packing, models and formatting of the text operators."""

from __future__ import annotations

import pickle
import tracemalloc
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from llm_cases import awkward, prose
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tripmill.llm import language, lm, packing, perspectives, queries, text, toxicity
from tripmill.llm.anchors import fragments

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_words_are_the_ascii_blank_separated_runs():
    texts = ["a b", None, "", " x\t\ny ", "é ü　z \x0b q\x0c", "end"]
    got = []
    for _, data, offsets in text.slices(pa.array(texts), limit=3):
        starts, ends, first = text.word_spans(data, offsets)
        raw = data.tobytes()
        got += [[raw[s:e] for s, e in zip(starts[a:b], ends[a:b])] for a, b in zip(first[:-1], first[1:])]
    assert got == [(t or "").encode().split() for t in texts]


def test_equal_ranges_hash_alike_and_others_do_not():
    values = np.array([5, 6, 7, 5, 6, 7, 5, 0, 0], np.uint64)
    hashes = text.Powers().ranges(values, np.array([0, 3, 0, 7, 7]), np.array([3, 6, 2, 8, 9]))
    assert hashes[0] == hashes[1]
    assert len(set(hashes.tolist())) == 4


@pytest.mark.parametrize(("window", "gram"), [(5, 2), (20, 4), (7, 7), (3, 1)])
def test_fragments_hold_every_window_once_and_equal_windows_meet(window, gram):
    rng = np.random.default_rng(3)
    sizes = [0, 3, window, 50, 200, window - 1, 90]
    values = text.mix(rng.integers(1, 4, sum(sizes)).astype(np.uint64))
    offsets = np.r_[0, np.cumsum(sizes)]
    found = fragments(values, offsets, window, gram, text.Powers())
    anchor_of, seen = {}, []
    for t, a, b, at, anchor in zip(found.text, found.start, found.end, found.anchor_at, found.anchor):
        assert offsets[t] <= a < b <= offsets[t + 1] and b - a < 2 * window
        for i in range(a, b - window + 1):
            assert i <= at <= i + window - gram
            seen.append(int(i))
            place = (int(anchor), int(at) - int(i))
            assert anchor_of.setdefault(values[i : i + window].tobytes(), place) == place
    assert sorted(seen) == [i for a, b in zip(offsets[:-1], offsets[1:]) for i in range(a, b - window + 1)]


def test_ids_are_the_tokenizer_files():
    whole = Tokenizer.from_file(PATH)
    ids = packing.byte_bpe(PATH)
    texts = [t for _, t in awkward() if t is not None]
    texts += ["it's  two\n\nlines \t x", " lead", "trail ", " a 　 b", "<|endoftext|> x", "1 22  333"]
    texts += ["don't stop\r\n\r\nnow", "a \x1c b", "﻿ü ß 漢字 🙂🙂 é"]
    for t in texts:
        assert ids(t) == whole.encode(t, add_special_tokens=False).ids, t[:50]


def test_packing_places_every_id_once(docs_of):
    whole = Tokenizer.from_file(PATH)
    rows = awkward()
    found = packing.pack(docs_of(rows), queries.encoder, capacity=256, buffer=8).collect()
    want = sorted([*whole.encode(t or "", add_special_tokens=False).ids, 1] for _, t in rows)
    texts, places = [], {}
    for r in found:
        assert 0 < r.length <= 256 and len(r.ids) == 4 * r.length
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    rest = [r for r in found]
    while rest:
        r = next(x for x in rest if x.start == 0)
        ids = b""
        total = r.doc_tokens
        while len(ids) < 4 * total:
            piece = next(x for x in rest if x.doc_id == r.doc_id and x.start == len(ids) // 4 and x.doc_tokens == total)
            rest.remove(piece)
            ids += piece.ids
        texts.append(np.frombuffer(ids, "<u4").tolist())
    assert sorted(texts) == want
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 256
    assert packing.pack(docs_of([]), queries.encoder).count() == 0


def test_fill_is_as_close_as_any_choice():
    rng = np.random.default_rng(5)
    for _ in range(60):
        lengths = rng.integers(1, 30, rng.integers(1, 9)).tolist()
        counts = {x: lengths.count(x) for x in lengths}
        longest = max(lengths)
        others = list(lengths)
        others.remove(longest)
        best = max(
            s for m in range(1 << len(others)) if (s := longest + sum(x for i, x in enumerate(others) if m >> i & 1)) <= 40
        )
        chosen = packing.fill(counts, 40)
        assert sum(chosen) == best
        assert sorted(chosen + [x for x, n in counts.items() for _ in range(n)]) == sorted(lengths)


def test_packing_query_wastes_little(spark, sf_dir, shared):
    found = queries.op4_packing(spark, sf_dir).groupBy("sequence_id").agg(F.sum("length").alias("n"))
    row = found.agg(F.count("n").alias("k"), F.sum("n").alias("n")).first()
    assert row.k * 2048 - row.n < 0.02 * row.n + 2048


@pytest.mark.parametrize("length", [11, 15, 19])
def test_packing_cuts_rests_above_half(docs_of, length):
    rows = [(i, "x" * (length - 1)) for i in range(41)] + [(100 + i, "y" * 50) for i in range(3)]
    docs = docs_of(rows).coalesce(1)
    found = packing.pack(docs, lambda: lambda text: list(text.encode()), capacity=20, buffer=8).collect()
    filled, pieces = {}, {}
    for r in found:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault(r.doc_id, []).append((r.start, r.ids))
    for spans in filled.values():
        assert [at for at, _ in sorted(spans)] == [sum(n for _, n in sorted(spans)[:k]) for k in range(len(spans))]
    totals = [sum(n for _, n in spans) for spans in filled.values()]
    assert max(totals) <= 20 and sum(n < 20 for n in totals) <= 1
    for i, text in rows:
        ids = b"".join(part for _, part in sorted(pieces[i]))
        assert np.frombuffer(ids, "<u4").tolist() == [*text.encode(), 1]


def test_toxic_words_are_learned_and_spelled_wrong(spark, docs_of):
    bad = ["idiot", "moron", "scum"]
    rows = [(i, prose(2 * i, 40) + (f" {bad[i % 3]} " * 3 if i % 2 else "")) for i in range(120)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows] + [(1, None), (2, 7)], "doc_id long, toxic int")
    model = toxicity.train(docs_of(rows), labels)
    tests = [(1000, prose(900, 40) + " idiiot morron scumm"), (1001, prose(902, 40)), (1002, None), (1003, "")]
    got = {r.doc_id: r.toxicity for r in toxicity.score(docs_of(tests).select("doc_id", "text"), model).collect()}
    assert got[1000] > 0.5 > got[1001]
    assert got[1002] == got[1003]
    assert len(toxicity.score(docs_of(awkward()).select("doc_id", "text"), model).collect()) == len(awkward())
    even = toxicity.train(docs_of([]), labels)
    assert toxicity.score(docs_of(tests).select("doc_id", "text"), even).first().toxicity == 0.5


def test_held_out_toxicity(spark, sf_dir, shared):
    scores = queries.op9_toxicity(spark, sf_dir)
    rows = scores.join(queries.table(spark, sf_dir, "labels"), "doc_id").filter("held_out").collect()
    toxic = [r.score for r in rows if r.toxic]
    clean = [r.score for r in rows if not r.toxic]
    wins = sum((t > c) + (t == c) / 2 for t in toxic for c in clean)
    assert not toxic or wins / (len(toxic) * len(clean)) > 0.5  # a few dozen rows to learn from here


def test_a_label_stands_for_one_text(docs_of, spark):
    docs = docs_of([(i % 5, f"text {i:03d}") for i in range(400)] + [(7, None), (None, "x"), (8, "alone")])
    labels = [(i, i % 2) for i in range(10)] + [(0, 0), (3, 0), (None, 1), (9, 5)]
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    found = toxicity.sample(docs, labels, "doc_id", "text", "toxic", 100).collect()
    expected = {(k, k % 2, f"text {395 + k}") for k in range(5)} | {(3, 0, "text 398"), (7, 1, None), (8, 0, "alone")}
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    assert toxicity.sample(docs, labels, "doc_id", "text", "toxic", 3).count() <= 3


def test_taken_names_are_refused(docs_of):
    docs = docs_of([(1, "a text")])
    with pytest.raises(ValueError, match="toxicity"):
        toxicity.score(docs, toxicity.fit([]))
    assert language.identify(docs, {}).columns == [*docs.columns, "lang_pred", "lang_score"]
    for name in ("Lang_Pred", "lang_score"):
        with pytest.raises(ValueError, match=name.lower()):
            language.identify(docs.withColumnRenamed("hash", name), {})


def test_profiles_tell_languages_apart(spark, docs_of):
    rows = [(i, "the cat and the dog were there with them") for i in range(5)]
    german = [(i + 10, "der hund und die katze waren auch dort mit ihnen") for i in range(5)]
    learned = docs_of(rows).unionByName(docs_of(german).withColumn("lang", F.lit("de")))
    known = language.profiles(learned.unionByName(docs_of([(30, None)])))
    tests = docs_of([(1, "the dog"), (2, "die katze"), (3, None), (4, "12 !?"), (5, ""), (6, "漢字"), (7, "𐐨𐐩 🙂")])
    got = {r.doc_id: (r.lang_pred, r.lang_score) for r in language.identify(tests.select("doc_id", "text"), known).collect()}
    assert got[1][0] == "en" and got[2][0] == "de"
    assert got[3] == got[4] == got[5] == ("und", 0.0)
    assert got[6][0] in known and got[7][0] in known
    assert all(0 <= s <= 1 for _, s in got.values())
    nothing = language.profiles(docs_of([]))
    assert nothing == {}
    assert language.identify(tests.select("text"), nothing).filter("lang_pred <> 'und'").isEmpty()


def test_grams_stay_in_words():
    letters = language.letter_table()
    assert len(language.grams("", letters)) == len(language.grams("1 2", letters)) == 0
    names = {"".join(chr(g >> s & 0x1FFFFF) for s in (42, 21, 0) if g >> s & 0x1FFFFF) for g in language.grams("Ab c", letters).tolist()}
    assert names == {"a", "b", "c", "\x01a", "ab", "b\x01", "\x01c", "c\x01", "\x01ab", "ab\x01", "\x01c\x01"}


def test_held_out_languages(spark, sf_dir, shared):
    found = queries.op10_language(spark, sf_dir).join(
        queries.table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id"
    )
    row = found.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right")).first()
    assert row.right > 0.95


def test_filter_gives_counts_back():
    hashes = text.mix(np.arange(1, 5001, dtype=np.uint64))
    counts = np.arange(5000) % 40 + 1
    bloom = lm.LogBloom({0: lm.filled(hashes, counts)}, 1)
    got = bloom.count(hashes, np.zeros(5000, int))
    want = lm.level_counts(lm.levels(counts))
    assert (got >= want).all() and (got == want).mean() > 0.98
    absent = bloom.count(text.mix(np.arange(10_000, 20_000, dtype=np.uint64)), np.zeros(10_000, int))
    assert (absent > 0).mean() < 0.02
    assert lm.LogBloom({}, 3).count(hashes, np.zeros(5000, int)).max() == 0


def brute_scores(rows, learned):
    from collections import Counter
    from math import log10

    from llm_cases import lowered

    texts = [[*lowered(t), None] for _, t in rows]
    counts, pairs = Counter(), Counter()
    for words, use in zip(texts, learned):
        if use:
            counts.update(words)
            pairs.update(zip([0, *words], words))
    total, distinct, n = sum(counts.values()), len(counts), sum(learned)
    single = lambda w: (counts[w] + 0.5) / (total + 0.5 * (distinct + 1))
    for (i, _), words in zip(rows, texts):
        base = sum(log10(single(w)) for w in words)
        model = sum(
            log10((pairs[b, w] + 100 * single(w)) / ((n if b == 0 else counts[b]) + 100))
            for b, w in zip([0, *words], words)
        )
        yield i, len(words), sum(counts[w] > 0 for w in words), total, base, model


@pytest.mark.parametrize(("frequent", "shard"), [(1 << 18, 1 << 26), (100, 1 << 26), (100, 3000), (0, 3000)])
def test_scores_are_brute_force_but_for_levels(docs_of, monkeypatch, frequent, shard):
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    monkeypatch.setattr(lm, "BLOCK_TOKENS", 5000)
    rows = awkward() + [(50 + i, prose(50 + i % 30, 80)) for i in range(60)]
    training = F.coalesce(F.col("doc_id") % 5 != 1, F.lit(False))
    learned = [i is not None and i % 5 != 1 for i, _ in rows]
    found = lm.score(docs_of(rows), training, shard_bytes=shard).collect()
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], r[4])
    want = sorted(brute_scores(rows, learned), key=order)
    got = sorted(map(tuple, found), key=order)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:4] == b[:4]
        assert a[4] == pytest.approx(b[4], rel=1e-9)
        assert a[5] == pytest.approx(b[5], abs=0.17 * a[1] + 0.01)


def test_nothing_to_learn_from(docs_of):
    assert lm.score(docs_of([]), F.lit(True)).count() == 0
    got = lm.score(docs_of([(1, "a b"), (2, None)]), F.lit(False)).orderBy("doc_id").collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in got] == [(3, 0, 0), (1, 0, 0)]
    assert all(np.isfinite(r.score) for r in got)


def turns(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, name string")


def test_every_participant_is_the_assistant_once(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", None), (1, 3, None, "who?"), (1, 1, "ann", "hi")]
    rows += [(2, 0, "system", "alone"), (None, 0, "cy", "<|im_end|>"), (3, None, "dd\n", "")]
    found = perspectives.rotate(turns(spark, rows))
    per = {}
    for r in found.collect():
        per.setdefault((r.conv_id, r.perspective), []).append(r)
    assert set(per) == {(1, "ann"), (1, "bob"), (None, "cy"), (3, "dd\n")}
    for (conv, who), own in per.items():
        assert len(own) == sum(r[0] == conv for r in rows)
        for r in own:
            assert (r.role == "assistant") == (r.mask_start is not None)
            if r.mask_start is not None:
                assert r.rendered[: r.mask_start] == "<|im_start|>assistant\n"
                assert r.rendered[r.mask_start : r.mask_end].endswith("<|im_end|>")
            assert r.rendered.count("<|im_end|>") == 1
    whole = {(r.conv_id, r.perspective): r for r in perspectives.dialogues(found).collect()}
    ann = whole[1, "ann"]
    assert ann.text.startswith("<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>assistant\nhi<|im_end|>\n")
    assert "<|im_start|>user name=bob\n<|im_end|>\n<|im_start|>user\nwho?" in ann.text
    assert [ann.text[m.start : m.end] for m in ann.masks] == ["hi<|im_end|>"] * 2
    assert perspectives.rotate(turns(spark, [])).count() == 0


def test_fold_is_crc32(spark):
    rows = spark.range(50).withColumnRenamed("id", "doc_id")
    assert all(r.f == zlib.crc32(str(r.doc_id).encode()) % 5 for r in rows.withColumn("f", queries.fold()).collect())


def test_training_gives_the_drivers_memory_back(docs_of, spark, monkeypatch):
    """What the bags of 6,000 texts took stayed with the driver, which later stages need."""
    order, fit, back = [], toxicity.fit, toxicity.give_back
    monkeypatch.setattr(toxicity, "fit", lambda bags: order.append("fit") or fit(bags))
    monkeypatch.setattr(toxicity, "give_back", lambda: order.append("back") or back())
    labels = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, toxic int")
    toxicity.train(docs_of([(1, "good words"), (2, "bad words")]), labels)
    assert order == ["fit", "back"]


def peak_bytes(run):
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_hashing_tokens_takes_little_memory():
    """Arrays of 64 bits for each byte of a slice took 60 MB of a worker that holds a filter, too."""
    column = pa.array([prose(i % 7, 400) for i in range(2000)])
    assert column.nbytes > 3 << 20

    def run():
        for _ in lm.token_hashes(column):
            pass

    assert peak_bytes(run) < 25 << 20
    found = [(h, np.diff(first)) for h, first in lm.token_hashes(column)]
    assert sum(len(sizes) for _, sizes in found) == 2000 and all((sizes == 401).all() for _, sizes in found)


def test_workers_get_the_filter_ready_for_use(spark):
    """Workers joined the blocks of a filter they were sent, so they held its bytes twice."""
    hashes = text.mix(np.arange(1, 3001, dtype=np.uint64))
    parts = {n: lm.filled(hashes[n::3], np.ones(1000, int)) for n in (0, 2)}
    blocks = spark.createDataFrame([(n, bytearray(b)) for n, b in parts.items()], "block long, bits binary")
    sent = pickle.loads(pickle.dumps(lm._gathered(blocks, 3), 5))
    assert sent.bytes.tobytes() == parts[0] + parts[2]
    got = sent.count(hashes, np.arange(3000) % 3)
    assert (got > 0).tolist() == [n != 1 for n in np.arange(3000) % 3]
    assert len(lm._gathered(blocks.limit(0), 3).bytes) == 0


def test_scoring_takes_little_memory():
    """The subwords of half a million characters took 100 MB and more of a worker."""
    column = pa.array([prose(i % 7, 400) for i in range(400)])

    def run():
        for texts in toxicity.some_texts(column):
            toxicity.subwords(texts)

    assert peak_bytes(run) < 60 << 20


def test_toxicity_stage_sends_a_text_once(spark, docs_of, monkeypatch):
    """Rows went to Python as a struct with their text, and with the text beside it."""
    score, sent = toxicity.score, []
    monkeypatch.setattr(toxicity, "score", lambda docs, *a, **b: sent.append(docs) or score(docs, *a, **b))
    rows = [*awkward(), *[(100 + i, "good " * 30 if i % 2 else "vile " * 30) for i in range(40)]]
    labels = spark.createDataFrame([(100 + i, 1 - i % 2) for i in range(40)], "doc_id long, toxic int")
    monkeypatch.setattr(corpus_pipeline, "table", lambda *_: labels)
    docs = docs_of(rows)
    got = corpus_pipeline.drop_toxic(spark, docs, "")
    assert [kind for _, kind in sent[0].dtypes] == [kind for _, kind in docs.dtypes]
    assert got.schema.simpleString() == docs.schema.simpleString()
    model = toxicity.train(docs, labels)
    want = score(docs.select("doc_id", "text"), model).filter("toxicity < 0.5").select("doc_id", "text")
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] or "")
    assert sorted(map(tuple, got.select("doc_id", "text").collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
    assert 20 <= want.filter("doc_id >= 100").count() < 40


def test_rows_are_handed_on_in_small_batches():
    rows = pa.RecordBatch.from_pydict({"n": list(range(900)), "text": [None, "", *["x" * 5000] * 898]})
    parts = list(text.parted(rows, "text"))
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([rows]))
    assert len(parts) > 3 and max(p.num_rows for p in parts) < 250
    assert not list(text.parted(rows.slice(0, 0), "text"))
