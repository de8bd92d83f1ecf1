"""A document corpus made ready for training, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm import decontamination, near_duplicates, packing, substring_dedup, toxicity
from tripmill.llm.marks import apart
from tripmill.llm.queries import encoder, table
from tripmill.llm.scratch import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: A document is rejected as toxic from this score on.
TOXIC = 0.5
#: Near duplicates share so many of a hundred five-word shingles.
SIMILAR = 80
#: Passages of so many words stay in the first document that has them.
PASSAGE = 50


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below ``TOXIC`` by a model of the labelled ones among them.

    Numbered names clash with none, so a row goes through the scoring with its text once.
    """
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    names = [f"_{i}" for i in range(len(docs.columns))]
    scored = toxicity.score(docs.toDF(*names), model, text_col=names[docs.columns.index("text")])
    return scored.filter(F.col("toxicity") < TOXIC).drop("toxicity").toDF(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, of the smallest id, of each group of near duplicates; all rows without words.

    Rows are told apart by id and text. Of rows equal in both any one stays, whatever else
    they carry; a null id is the largest.
    """
    found = near_duplicates.near_duplicates(docs, percent=SIMILAR).filter(F.col("n_shingles") > 0)
    found = written(found.select(F.col("doc_id").alias("_i"), F.col("text_hash").alias("_h"), "first"), "near")
    again = found.filter("first").groupBy("_i", "_h").count().filter(F.col("count") > 1)
    again = written(again.select("_i", "_h"), "again")
    gone = written(found.filter(~F.col("first")).select("_i", "_h").unionByName(again), "gone")

    kept = without(docs, gone)
    if again.isEmpty():
        return kept
    copies = docs.join(again, same_text(docs, again), "left_semi")
    return kept.unionByName(copies.dropDuplicates(["doc_id", "text"]))


def same_text(docs: DataFrame, rows: DataFrame) -> Column:
    return docs["doc_id"].eqNullSafe(rows["_i"]) & (F.xxhash64(docs["text"]) == rows["_h"])


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` but for the ids and text hashes in ``gone`` (``_i, _h``); most stay without a shuffle."""
    own = F.xxhash64("doc_id", F.xxhash64("text"))
    some, others = apart(docs, gone.select(F.xxhash64("_i", "_h").alias("mark")), own)
    return others.unionByName(some.join(gone, same_text(some, gone), "left_anti"))


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that start earlier elsewhere; left out where nothing stays.

    A text that loses nothing stays as it is; in one that does, words are joined by one space.
    """
    rest = [c for c in docs.columns if c != "text"]
    found = substring_dedup.dedup(docs, window=PASSAGE, carry=rest, with_text=True)
    cut = F.size("spans") > 0
    kept = found.filter(~cut | (F.col("kept_text") != ""))
    columns = {c: F.col("carried")[c] for c in rest}
    columns["text"] = F.when(cut, F.col("kept_text")).otherwise(F.col("whole_text"))
    if "n_chars" in rest:
        counted = F.length("kept_text").cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(cut, counted).otherwise(columns["n_chars"])
    return kept.select(*[columns[c].alias(c) for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with a benchmark item."""
    found = decontamination.contamination(docs, table(spark, sf_dir, "benchmark"))
    bad = found.filter(F.size("hits") > 0).select(F.col("doc_id").alias("_i"), F.col("text_hash").alias("_h"))
    return without(docs, written(bad, "contaminated"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as packed token sequences."""
    return packing.pack(docs, encoder)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("substring dedup", cut_repeated_passages),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: Model training and tokenisation have no SQL form; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
