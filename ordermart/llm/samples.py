"""Bounded samples of labelled documents, for fitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermart.llm.common import text_of
from ordermart.session import freeze

# Labelled rows of each class that a model is fitted on, at most.
PER_CLASS = 10_000


def fold(folds: int) -> Column:
    """Fold of a document: crc32 of its id as text, modulo ``folds``."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, per_class: int = PER_CLASS) -> DataFrame:
    """``text, positive, weight`` of at most ``per_class`` labelled texts of each class.

    The ids with the least hashes are taken; ``weight`` is the share by which the sample
    of a class stands for all its labelled rows. Each text counts once.
    """
    usable = labels.where(allowed & F.col(label).isin(0, 1)).select("doc_id", F.col(label).alias("positive"))
    sizes = dict(usable.groupBy("positive").count().collect())
    picked = None
    for value in (0, 1):
        own = usable.where(F.col("positive") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        own = own.withColumn("weight", F.lit(max(1.0, sizes.get(value, 0) / per_class)))
        picked = own if picked is None else picked.unionByName(own)
    # At most 2 * per_class rows of three numbers.
    sample = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(picked.distinct()), "doc_id")
    return freeze(
        sample.groupBy("text").agg(F.max("positive").alias("positive"), F.max("weight").alias("weight")), "labelled-sample"
    )
