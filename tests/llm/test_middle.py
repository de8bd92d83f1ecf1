"""Fill-in-the-middle by secondary sorts, against brute force and as a round trip."""

from __future__ import annotations

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import awkward, prose

from tripmill.llm import middle, queries


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(i, text):
    text = text or ""
    h = sha(f"1:{'' if i is None else i}")
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return i, n, "plain", None, None, sha(text), sha(text)
    if h4 % 100 < 20:
        form, out = "spm", f"<S>{s}<P>{p}<M>{m}"
    else:
        form, out = "psm", f"<P>{p}<S>{s}<M>{m}"
    return i, n, form, len(p), len(m), sha(out), sha(text)


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is not None, r[0] or 0, *r[5:]))


ODD = ["a<P>b", "<M>", "x <S", "P> y", "<P", "é<", "M>M>", "<<S>>", "1a2b3c\n\t漢🙂é<"]


@pytest.mark.parametrize(("units", "block"), [(4096, 1 << 20), (3, 7), (1, 1)])
def test_transform_is_brute_force(spark, docs_of, monkeypatch, units, block):
    monkeypatch.setattr(middle, "PIECE_UNITS", units)
    monkeypatch.setattr(middle, "BLOCK_CHARS", block)
    rows = [r for r in awkward() if units > 1 or len(r[1] or "") < 5000]
    rows += [(100 + i, t) for i, t in enumerate(ODD)] + [(200 + i, prose(i, 30) + "<") for i in range(60)]
    rows += [(None, None), (None, ""), (7, "other text")]
    found = middle.transform(docs_of(rows).repartition(5))
    assert [f.dataType.simpleString() for f in found.schema] == ["bigint", "bigint", "string", "bigint", "bigint", "string", "string"]
    got = found.collect()
    assert order(got) == order(brute(*r) for r in rows)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 400), st.text(st.sampled_from("ab Z9<>PSM\n漢é"), max_size=60), st.integers(1, 5))
def test_pieces_make_the_output_and_give_the_text_back(i, text, units):
    before = middle.PIECE_UNITS
    middle.PIECE_UNITS = units
    try:
        (_, n, form, prefix, mid), *output = middle.pieces(i, text)
    finally:
        middle.PIECE_UNITS = before
    want = brute(i, text)
    assert (i, n, form, prefix, mid, sha(b"".join(output).decode())) == want[:6]
    for piece in output:
        assert 0 < len(re.findall(rb"[A-Za-z]+|[^A-Za-z]", piece)) <= max(units * 4, 3)
    back = {0: b"", 1: b"", 2: b""}
    for place, part in middle.sections(form, iter(output)):
        back[place] += part
    assert (back[0] + back[1] + back[2]).decode() == text


def test_positions_are_found_block_by_block(monkeypatch):
    text = "ab1cd ef" * 50 + "x" * 100
    whole = [m.start() for m in re.finditer(r"[A-Za-z]+|[^A-Za-z]", text)]
    for block in (1, 3, 64, 1 << 20):
        monkeypatch.setattr(middle, "BLOCK_CHARS", block)
        assert [int(x) for starts in middle.unit_starts(text) for x in starts] == whole


def test_copies_spread_over_tasks(spark, docs_of):
    rows = [(3, prose(3, 50))] * 400 + [(4, "x")]
    found = middle.transform(docs_of(rows).repartition(2))
    assert sorted(map(tuple, found.collect())) == sorted(brute(*r) for r in rows)
    sizes = found.rdd.glom().map(len).collect()
    assert max(sizes) < 120  # eight partitions


def test_sorts_follow_the_text(spark, docs_of, monkeypatch):
    docs = docs_of([(1, "x" * 1000), (2, None), (3, "é" * 500)])
    assert middle.sorts(docs, "text") == 8 == middle.sorts(docs_of([]), "text")
    monkeypatch.setattr(middle, "SORT_BYTES", 100)
    assert middle.sorts(docs, "text") == 20
    assert middle.transform(docs).count() == 3
    monkeypatch.setattr(middle, "MAX_SORTS", 12)
    assert middle.sorts(docs, "text") == 12


def test_second_sort_moves_nothing(spark, docs_of):
    found = middle.transform(docs_of([(1, "a b c")]))
    assert found._jdf.queryExecution().toRdd().toDebugString().count("ShuffledRDD") == 1


def test_empty_tables_and_bad_names(spark, docs_of):
    assert middle.transform(docs_of([])).count() == 0
    with pytest.raises(ValueError, match="form"):
        middle.transform(docs_of([]).withColumnRenamed("lang", "form"), id_col="form")


def test_query_agrees_with_sql(spark, sf_dir, shared):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = con.execute(queries.oracle_sql()["op12_fill_in_middle"]).fetchall()
    assert order(queries.op12_fill_in_middle(spark, sf_dir).collect()) == order(want)
