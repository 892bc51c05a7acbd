"""Shards of near-equal bytes: longest processing time first.

Rows of equal text form a group that stays together. Groups go, largest first, to the
least-loaded shard, which a heap yields. A heap over all groups would be one task's work,
so the long tail is scheduled in two levels by the same rule:

* a group of at least ``1 / grain`` of a shard is scheduled on the driver; there can be no
  more than ``shards * grain`` of them, whatever the input;
* smaller groups are dealt by hash into cells of a bounded number of groups; each cell
  schedules its groups into bundles through a heap of its own, and the driver then
  schedules the bundles among the large groups.

Null and empty texts are one group of ``overhead`` bytes a row. A group larger than a
shard's share is kept whole, so its shard is as large as the group. Repeated rows count
as often as they occur. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermart.llm.common import text_key, text_of
from ordermart.session import checkpoint, freeze

# Groups in a cell, and at least so many cells: bounds of one task's work.
CELL_GROUPS = 100_000
LEAST_CELLS = 32


def schedule(sizes: np.ndarray, shards: int) -> np.ndarray:
    """Longest first to the least-loaded shard; ties by position and shard number."""
    heap = [(0, shard) for shard in range(shards)]
    placed = np.zeros(len(sizes), dtype=np.int32)
    for item in np.argsort(-sizes, kind="stable"):
        load, shard = heap[0]
        placed[item] = shard
        heapq.heapreplace(heap, (load + int(sizes[item]), shard))
    return placed


def _bundles(per_cell: int):
    def place(cell: pd.DataFrame) -> pd.DataFrame:
        cell = cell.sort_values(["bytes", "key"], ascending=[False, True], ignore_index=True)
        cell["bundle"] = schedule(cell["bytes"].to_numpy(), per_cell)
        return cell

    return place


def group_shards(groups: DataFrame, shards: int, grain: int = 1000) -> DataFrame:
    """``key, shard`` for ``groups`` of columns ``key`` (binary, unique) and ``bytes``."""
    spark = groups.sparkSession
    total, n = groups.agg(F.sum("bytes"), F.count(F.lit(1))).first()
    floor = (total or 0) / (shards * grain)
    large = groups.where(F.col("bytes") >= floor).select("key", "bytes").toPandas()
    large = large.sort_values(["bytes", "key"], ascending=[False, True], ignore_index=True)
    cells = max(LEAST_CELLS, math.ceil(n / CELL_GROUPS))
    per_cell = max(shards, math.ceil(shards * grain / cells))
    small = freeze(
        groups.where(F.col("bytes") < floor)
        .select(F.pmod(F.xxhash64("key"), F.lit(cells)).cast("int").alias("cell"), "key", "bytes")
        .groupBy("cell")
        .applyInPandas(_bundles(per_cell), "cell int, key binary, bytes long, bundle int"),
        "shard-bundles",
    )
    # At most cells * per_cell rows: shards * grain, or shards for each CELL_GROUPS groups.
    bundles = small.groupBy("cell", "bundle").agg(F.sum("bytes").alias("bytes")).toPandas()
    bundles = bundles.sort_values(["bytes", "cell", "bundle"], ascending=[False, True, True], ignore_index=True)
    shard = schedule(
        np.concatenate([large["bytes"].to_numpy(np.int64), bundles["bytes"].to_numpy(np.int64)]), shards
    )
    keys = pa.table({"key": pa.array(large["key"].map(bytes), pa.binary()), "shard": shard[: len(large)]})
    places = pa.table(
        {
            "cell": bundles["cell"].to_numpy(np.int32),
            "bundle": bundles["bundle"].to_numpy(np.int32),
            "shard": shard[len(large) :],
        }
    )
    return spark.createDataFrame(keys).unionByName(
        small.join(spark.createDataFrame(places), ["cell", "bundle"]).select("key", "shard")
    )


def _number(shards: int):
    def number(batches):
        seen = np.zeros(shards, dtype=np.int64)
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            order = np.argsort(shard, kind="stable")
            count = np.bincount(shard, minlength=shards)
            rank = np.empty(len(shard), dtype=np.int64)
            rank[order] = np.arange(len(shard)) - np.repeat(np.cumsum(count) - count, count)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rank + seen[shard])], [*batch.schema.names, "place"]
            )
            seen += count

    return number


def shard_documents(docs: DataFrame, shards: int = 24, overhead: int = 8, grain: int = 1000) -> DataFrame:
    """Every row of ``docs`` with its shard and its gapless slot there.

    Columns: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``; the law is
    ``bytes``, so ``grown_shard`` is null.
    """
    text = text_of()
    rows = freeze(
        docs.select(
            "doc_id",
            (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            text_key().alias("key"),
        ),
        "shard-rows",
    )
    groups = freeze(rows.groupBy("key").agg(F.sum("size").alias("bytes")), "shard-groups")
    # Stored with its row order, so that places and counts below agree on any retry.
    placed = checkpoint(
        rows.join(group_shards(groups, shards, grain), "key").select("doc_id", "size", "text_crc32", "shard")
    ).select("*", F.spark_partition_id().alias("part"))
    counts = placed.groupBy("part", "shard").count()
    # One row per partition of the stored rows and shard.
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.sum("count").over(earlier)
    offsets = counts.select("part", "shard", F.coalesce(before, F.lit(0)).alias("before"))
    numbered = placed.mapInArrow(
        _number(shards), "doc_id long, size long, text_crc32 long, shard int, part int, place long"
    )
    return numbered.join(offsets, ["part", "shard"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("before") + F.col("place")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )

