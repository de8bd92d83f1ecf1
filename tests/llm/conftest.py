from __future__ import annotations

import pytest

from tripmill.llm import scratch


@pytest.fixture()
def shared(spark, tmp_path, monkeypatch):
    """A folder for written tables, of its own for each test."""
    monkeypatch.setitem(scratch._made, spark.sparkContext.applicationId, str(tmp_path))
    return str(tmp_path)


@pytest.fixture()
def docs_of(spark, shared):
    """A documents table from (doc_id, text) rows, with columns that could clash."""

    def make(rows):
        extra = [(i, t, "en", None, 0, "x", "y", "z", 1) for i, t in rows]
        return spark.createDataFrame(
            extra,
            "doc_id long, text string, lang string, source string, n_chars long, "
            "_id string, spans string, toxicity string, hash int",
        )

    return make
