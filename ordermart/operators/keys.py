"""Surrogate keys without a single-partition window."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.session import checkpoint

# monotonically_increasing_id() keeps the position within the partition in its low 33 bits.
_POSITION_BITS = (1 << 33) - 1


def highest_key(df: DataFrame, surrogate: str) -> int:
    """Highest key in use, 0 for an empty table."""
    return df.agg(F.coalesce(F.max(surrogate), F.lit(0)).cast("long")).first()[0]


def assign_surrogate_keys(
    df: DataFrame, surrogate: str, order_by: Sequence[str], start: int = 0, ranges: int | None = None
) -> DataFrame:
    """Number the rows ``start + 1 …`` by ``order_by``, as a global row_number would.

    Rows are range-partitioned and sorted by ``order_by`` (its last column should make it
    unique, so a hot leading value still splits) and then checkpointed: counts and keys come
    from the same stored rows, whatever executor is lost meanwhile. Only one count per
    partition reaches the driver. The result keeps that layout, so writing it gives one
    sorted file per range; ``ranges`` is their number, else the session's.
    """
    spark = df.sparkSession
    parts = [] if ranges is None else [ranges]
    stored = checkpoint(df.repartitionByRange(*parts, *order_by).sortWithinPartitions(*order_by))
    partition = F.spark_partition_id().alias("_partition")
    counts = sorted(stored.groupBy(partition).count().collect())
    offsets = accumulate((row["count"] for row in counts), initial=start)
    # One row per partition that holds data: small enough to broadcast by construction.
    first_keys = spark.createDataFrame(
        [(row["_partition"], offset) for row, offset in zip(counts, offsets)],
        "_partition int, _offset long",
    )
    position = F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS)).alias("_position")
    return (
        stored.select("*", partition, position)
        .join(F.broadcast(first_keys), "_partition")
        .select(
            (F.col("_offset") + F.col("_position") + 1).alias(surrogate),
            *[F.col(name) for name in df.columns],
        )
    )
