"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """First row per key in the given order; NULL keys form one group.

    The rank filter lets Spark cut every map task to one row per key before the shuffle,
    so a key that holds a large share of the rows never meets in one task.
    """
    window = Window.partitionBy(*keys).orderBy(*order_by)
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def latest_ingest() -> list[Column]:
    """Newest ingest first; equal times are settled by the row hash, then by the run."""
    return [
        F.col("_ingested_at").desc_nulls_last(),
        F.col("_row_hash").asc(),
        F.col("_pipeline_run_id").asc(),
    ]
