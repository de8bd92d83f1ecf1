"""The filter of wanted rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripmill.llm import marks


@pytest.mark.parametrize(("rows", "most"), [(0, 1 << 27), (1, 1 << 27), (3000, 1 << 27), (3000, 1 << 9)])
def test_wanted_rows_always_pass(spark, monkeypatch, rows, most):
    monkeypatch.setattr(marks, "MAX_BITS", most)
    hashes = spark.range(20_000).select("id", F.xxhash64("id").alias("mark"))
    some = marks.marks(hashes.filter(F.col("id") < rows).select("mark"))
    held = some.holds(np.array([r.mark for r in hashes.orderBy("id").collect()], np.int64))
    assert held[:rows].all()
    assert 64 * len(some.words) <= max(64, most)
    if most > 1 << 20:
        assert held[rows:].mean() < 0.1
    assert len(some.holds(np.zeros(0, np.int64))) == 0


def test_rows_are_told_apart(spark, shared):
    hashes = spark.range(5000).select("id", F.xxhash64("id").alias("mark"))
    some, others = marks.apart(hashes, hashes.filter("id % 3 = 0").select("mark"), F.col("mark"))
    assert some.columns == others.columns == hashes.columns
    passed, rest = [r.id for r in some.collect()], [r.id for r in others.collect()]
    assert sorted(passed + rest) == list(range(5000))
    assert set(range(0, 5000, 3)) <= set(passed) and len(passed) < 2300
    nobody, every = marks.apart(hashes, hashes.limit(0).select("mark"), F.col("mark"))
    assert nobody.isEmpty() and every.count() == 5000
