"""Best-fit packing by exact complements, and the encoder that packing reads."""

from __future__ import annotations

from itertools import combinations_with_replacement

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import awkward, prose
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tripmill.llm import best_fit, queries
from tripmill.llm.tokens import Encoder

FILES = ("byte_bpe_50k.json", "word_bpe_49k.json")

TEXTS = [
    "it's  two\n\nlines \t x",
    " lead",
    "trail ",
    " a 　 b",
    "<|endoftext|> x",
    "a<|endoftext|>b <|startoftext|> <| endoftext|> <|ENDOFTEXT|>",
    "don't stop\r\n\r\nnow 'S it'LL",
    "a \x1c b \x1f \x1fc\x0b\x0c",
    "﻿ü ß 漢字 🙂🙂 é H̱ x ̱ İ ΣΑΣ",
    "x" * 5000 + " " * 300 + "!" * 300,
    "a-b/c.d,e f_g 1.5% $3 (x) [y] <z> 22 333",
    "\u0085a\u0085 b  c d　 　e",
    "",
    " ",
]


def whole(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


@pytest.fixture(scope="module")
def encoders():
    return {name: (Encoder(public_tokenizers.path(name)), whole(name)) for name in FILES}


@pytest.mark.parametrize("name", FILES)
def test_ids_are_the_tokenizer_files(encoders, name, monkeypatch):
    own, library = encoders[name]
    texts = [*TEXTS, None, *[t for _, t in awkward()]]
    for remembered in (400_000, 5):
        monkeypatch.setattr("tripmill.llm.tokens.REMEMBERED", remembered)
        monkeypatch.setattr("tripmill.llm.tokens.SLICE_BYTES", 3000)
        got = {}
        for encoder in (own, Encoder(public_tokenizers.path(name))):
            for row, ids, ends in encoder.column(pa.array(texts)):
                for i in range(len(ends) - 1):
                    got[row + i] = ids[ends[i] : ends[i + 1]].tolist()
            assert [got[i] for i in range(len(texts))] == [
                library.encode(t or "", add_special_tokens=False).ids for t in texts
            ]


ODD = st.text(st.sampled_from("aAzé'sS1 \n\t.,-　\u0085\x1c\x1f  ̱́漢🙂"), max_size=25)


@pytest.mark.parametrize("name", FILES)
def test_ids_of_odd_texts(encoders, name):
    own, library = encoders[name]

    @settings(max_examples=400, deadline=None)
    @given(st.lists(ODD, max_size=4))
    def run(texts):
        got = []
        for _, ids, ends in own.column(pa.array(texts, pa.string())):
            got += [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])]
        assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]

    run()


def test_a_tokenizer_that_joins_words_is_refused(tmp_path):
    from tokenizers import models, pre_tokenizers

    joined = Tokenizer(models.WordLevel({"x": 0}, unk_token="x"))
    joined.pre_tokenizer = pre_tokenizers.Split("|", "removed")
    joined.save(str(tmp_path / "t.json"))
    with pytest.raises(ValueError, match="over a cut"):
        Encoder(str(tmp_path / "t.json"))


def sequences(rows):
    """Each sequence's (offset, end, length) pieces, out of a plan."""
    found = {}
    for length, low, high, each, first, offset in rows.tolist():
        assert (high - low) % each == 0
        for k in range((high - low) // each):
            found.setdefault(first + k, []).append((offset, offset + each * length, length))
    return found


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 40), st.data())
def test_a_plan_places_every_piece_once_and_leaves_no_gap(capacity, data):
    lengths = data.draw(st.lists(st.integers(1, capacity), max_size=60))
    counts = {x: lengths.count(x) for x in lengths}
    rows = best_fit.plan(counts, capacity)
    numbers = {}
    for length, low, high, *_ in rows.tolist():
        numbers.setdefault(length, []).append((low, high))
    assert set(numbers) == set(counts)
    for length, spans in numbers.items():
        assert [low for low, _ in sorted(spans)] == [0, *[high for _, high in sorted(spans)][:-1]]
        assert max(high for _, high in spans) == counts[length]
    ends = []
    for spans in sequences(rows).values():
        spans.sort()
        assert [a for a, _, _ in spans] == [0, *[b for _, b, _ in spans[:-1]]]
        ends.append(spans[-1][1])
    assert all(end <= capacity for end in ends)
    # Best fit: two sequences that fit in one are never both left.
    assert len(ends) < 2 or sum(sorted(ends)[:2]) > capacity
    least = max(-(-sum(lengths) // capacity), sum(2 * x > capacity for x in lengths))
    assert least <= len(ends) <= 1.7 * least + 1


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=3, max_size=16), st.integers(1, 40), st.integers(1, 3))
def test_a_combination_is_found_where_there_is_one(counts, total, parts):
    left = np.array([0, *counts, *[0] * 40])
    have = [x for x, n in enumerate(left.tolist()) for _ in range(n)]
    exists = any(
        sum(c) == total and all(have.count(x) >= c.count(x) for x in c)
        for c in combinations_with_replacement(sorted(set(have)), parts)
    )
    index = best_fit.Complements(left)
    for _ in range(2):  # looked up, then remembered
        found = index.find(total, parts)
        assert (found is not None) == exists
        assert not found or (sum(found) == total and len(found) == parts)


def test_gaps_are_filled_exactly_before_anything_else():
    left = np.zeros(101, np.int64)
    for length, n in {100: 2, 70: 5, 30: 3, 20: 1, 10: 1, 60: 1, 25: 1, 8: 1, 7: 1}.items():
        left[length] = n
    used = dict(best_fit.complete(left, 100))
    assert used == {(100,): 2, (70, 30): 3, (70, 20, 10): 1, (60, 25, 8, 7): 1}
    assert np.flatnonzero(left).tolist() == [70] and left[70] == 1


def test_many_equal_lengths_cost_no_more_than_few():
    rows = best_fit.plan({1000: 10**12, 3096: 10**11, 50: 7}, 4096)
    assert len(rows) < 20
    assert rows[rows[:, 0] == 1000][:, 2].max() == 10**12


def pieces_of(found):
    """Ids of each document's texts; checks order and gaps of the pieces."""
    places, texts, left = {}, [], list(found)
    for r in found:
        assert 0 < r.length == len(r.ids) // 4
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in places.values():
        spans.sort()
        assert [a for a, _ in spans] == [sum(n for _, n in spans[:k]) for k in range(len(spans))]
    for r in sorted(left, key=lambda r: r.piece):
        assert r.start == r.piece * max(x.length for x in found) or r.piece == 0 or r.start % r.piece == 0
        texts.append((r.doc_id, r.piece, r.start, r.ids))
    return texts, [sum(n for _, n in spans) for spans in places.values()]


def test_packing_is_brute_force(docs_of):
    rows = [*awkward(), (77, "<|endoftext|> kept"), (78, prose(8, 90))]
    library = whole("word_bpe_49k.json")
    found = best_fit.pack(docs_of(rows).repartition(3), queries.word_encoder, capacity=300).collect()
    texts, totals = pieces_of(found)
    want = []
    for i, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), 300)):
            want.append((i, piece, start, np.array(ids[start : start + 300], "<u4").tobytes()))
    order = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    assert sorted(texts, key=order) == sorted(want, key=order)
    assert max(totals) <= 300
    assert sum(sorted(totals)[:2]) > 300


def test_empty_tables_and_bad_names(docs_of):
    assert best_fit.pack(docs_of([]), queries.word_encoder).count() == 0
    with pytest.raises(ValueError, match="offset"):
        best_fit.pack(docs_of([]).withColumn("offset", F.lit(1)), queries.word_encoder, id_col="offset")
    with pytest.raises(ValueError, match="capacity"):
        best_fit.pack(docs_of([]), queries.word_encoder, capacity=0)


def test_copies_of_one_length_share_sequences(docs_of):
    rows = [(1, "x" * 9)] * 50 + [(i, "y" * 19) for i in range(20)] + [(None, None)] * 3
    found = best_fit.pack(docs_of(rows).repartition(5), lambda: lambda text: list(text.encode()), capacity=30)
    _, totals = pieces_of(found.collect())
    assert sum(totals) == 50 * 10 + 20 * 20 + 3
    assert len(totals) == 20 + 10 + 1  # 10 + 20, then 3 x 10, then what is left


def test_query_fills_its_sequences(spark, sf_dir, shared):
    found = queries.op13_best_fit(spark, sf_dir)
    assert [f.dataType.simpleString() for f in found.schema] == ["bigint", "int", *["bigint"] * 5]
    per = found.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    row = per.agg(F.count("n").alias("k"), F.sum("n").alias("n"), F.max("end").alias("most")).first()
    assert row.most <= 4096 and row.k <= 1.01 * -(-row.n // 4096) + 1


@pytest.mark.parametrize("name", FILES)
def test_accented_words_are_encoded_many_in_one_text(name):
    """They were encoded one by one, which took most of the time on such texts."""
    library = whole(name)
    encoder = Encoder(public_tokenizers.path(name))
    sent = []

    class Counting:
        def encode_batch_fast(self, texts, **options):
            sent.extend(texts)
            return library.encode_batch_fast(texts, **options)

    encoder.whole = Counting()
    marks = ("", ".", ", ", "?!", "'s", "́", "×", "\n")
    words = [f"{a}{b}{c}x{marks[(i + j) % 8]}" for i, a in enumerate("éÑßüÉç") for j, b in enumerate("aàœñnÿÀ") for c in "eèöz"]
    texts = [" ".join(words), "".join(words), " ".join(f"é{i:b}è" for i in range(9)), "ÉÀ. é"]
    texts.append(" ".join(f"{a}{b}{c}{d}" for a in "éñüç" for b in "aeio" for c in "éñüçàè" for d in "stnràé"))
    got = []
    for _, ids, ends in encoder.column(pa.array(texts)):
        got += [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:])]
    assert got == [library.encode(text, add_special_tokens=False).ids for text in texts]
    distinct = len({word for text in texts for word in text.split()})
    assert distinct > 600 and len(sent) < distinct / 3


def test_a_lasting_encoder_is_one_object_and_gives_the_same_ids_again():
    texts = ["one two né.", "two three né!", "x" * 100, "one"]
    first = queries.lasting_encoder()
    seen = [[i for _, ids, _ in first.column(pa.array(texts)) for i in ids.tolist()] for _ in range(2)]
    assert queries.lasting_encoder() is first and seen[0] == seen[1]
    assert seen[0] == [i for t in texts for i in whole(FILES[0]).encode(t, add_special_tokens=False).ids]
    assert isinstance(queries.word_encoder(), Encoder) and queries.word_encoder() is queries.word_encoder()
