"""Corpus pipeline: stages over ``documents``, each a training-data operator.

Every stage takes the session, the documents its predecessor kept and the folder of the
tables, and returns the documents it keeps with the columns of ``documents``; the last one
returns the packed pieces. ``run`` writes each stage's rows to the shared folder and gives
the stored rows to the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ordermart.llm.common import reach_workers, read_table
from ordermart.llm.contamination import drop_contaminated
from ordermart.llm.jaccard import drop_near_copies
from ordermart.llm.packing import pack_documents
from ordermart.llm.spans import deduplicate_substrings
from ordermart.llm.toxicity import drop_toxic
from ordermart.session import freeze


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, fitted on the labelled ones among them, does not reject."""
    return drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies."""
    reach_workers(spark)
    return drop_near_copies(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the sentences of passages that came before."""
    reach_workers(spark)
    return deduplicate_substrings(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no phrase of the benchmark."""
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the kept documents in sequences of several lengths."""
    reach_workers(spark)
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]

# The toxicity model and the packing cannot be said in SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = freeze(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
