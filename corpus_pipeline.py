"""A training corpus out of ``documents``, stage by stage.

Each stage works on all that the one before it kept; its result is written
and read again by the next. All stages but the last return rows of
``documents`` unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starfold.llm.base import fold, staged, table
from starfold.llm.decontaminate import drop_contaminated
from starfold.llm.exact_dedup import drop_exact_copies
from starfold.llm.pieces import default_model, round_trip
from starfold.llm.toxicity import drop_toxic
from starfold.llm.trie_join import drop_similar


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; learned from the labels of two thirds, as in the operator's query."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents"), fold("doc_id", 3) != 1)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays: the longest original, then the smallest id."""
    return drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar texts (five words, 0.8 or more) stays: the smallest id."""
    return drop_similar(docs, k=5, threshold=(80, 100))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's pieces, with the proof that they decode to its text."""
    return round_trip(docs, default_model(), keep=True)


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_copies), ("ngram_join", near_copies),
          ("decontamination", benchmark_leaks), ("pieces", pieces)]
#: Neither the classifier nor the segmentation can be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: one row with its pieces for each document that is kept."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
