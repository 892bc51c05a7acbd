"""Hard negatives by exact inner products, scored the Four-Russians way.

Components become integers, ``floor(scale * x)``. Of every candidate the bits of its
components in two's complement are stored plane by plane, eight dimensions to a byte. Of
every anchor and group of eight dimensions a table holds the 256 sums of subsets of its
components. A candidate's byte in a plane is the index of its subset, so the inner product
is one lookup for each plane and group, added up from the sign plane downwards with a
doubling between planes: exact, whatever the values are.

Candidates stay where they are stored; anchors come to them in blocks of ``ANCHORS``, tables
made ``TABLES`` anchors at a time in the task. A task keeps only the best rows of each
anchor, ties by the smaller id, so hot vectors or labels never gather. The first pass finds
the positives of all anchors of a block; the second knows their scores and keeps, for each
of them, the best rows of other labels within its range.

Defined results: rows with a null id, label or vector, with a null or non-finite component,
or with a scaled component of ``sqrt(2**62 / length)`` or more in size, whose scores might
not fit 64 bits, take no part. Vectors are scored against those of the same length only; an
empty vector has score 0 with every other. A repeated row is a further row, but rows with
the anchor's own id are never its partners; rows equal in id, label and vector are one
anchor. Anchors without positives, positives without negatives and empty tables give no
rows. Further columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermart.llm.common import binary_rows
from ordermart.session import freeze

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
# Least and greatest score of a negative, in hundredths of the positive's.
LOW, HIGH = 30, 90
# Anchors sent to the tasks at once, anchors of one set of tables, candidates of one lookup.
ANCHORS = 50_000
TABLES = 256
ROWS = 1024

NONE = -(1 << 62)  # below every score


def usable(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``id, label, vector`` with whole numbers, of the rows that take part."""
    x = vectors.select(
        F.col("id").cast("long").alias("id"),
        F.col("label").cast("long").alias("label"),
        F.col("vector").cast("array<double>").alias("vector"),
    ).where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull())
    limit = F.sqrt(F.lit(2.0**62) / F.greatest(F.size("vector"), F.lit(1)))

    def fits(v: Column) -> Column:
        return F.coalesce(F.abs(F.floor(v * F.lit(float(scale))).cast("double")) < limit, F.lit(False)) & ~F.isnan(v)

    return x.where(F.forall("vector", fits)).withColumn(
        "vector", F.transform("vector", lambda v: F.floor(v * F.lit(float(scale))))
    )


def pack_planes(values: np.ndarray, planes: int) -> np.ndarray:
    """Bits of whole numbers (rows, dimensions) as bytes (rows, planes, groups of eight)."""
    shifts = np.arange(planes, dtype=np.int64)[None, :, None]
    return np.packbits(((values[:, None, :] >> shifts) & 1).astype(np.uint8), axis=2, bitorder="little")


def unpack_planes(packed: np.ndarray) -> np.ndarray:
    """The numbers again, padded with zeros to whole groups."""
    bits = np.unpackbits(packed, axis=2, bitorder="little").astype(np.int64)
    weights = np.int64(1) << np.arange(packed.shape[1], dtype=np.int64)
    weights[-1] = -weights[-1]
    return np.einsum("rpd,p->rd", bits, weights)


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """Tables (group, subset, anchor) of the sums over each subset of eight dimensions."""
    n, dimensions = anchors.shape
    grouped = anchors.reshape(n, dimensions // 8, 8)
    tables = np.zeros((dimensions // 8, 256, n), dtype=np.int64)
    for bit in range(8):
        size = 1 << bit
        tables[:, size : 2 * size] = tables[:, :size] + grouped[:, :, bit].T[:, None, :]
    return tables


def inner_products(tables: np.ndarray, packed: np.ndarray) -> np.ndarray:
    """Scores (candidate, anchor) by lookups, from the sign plane downwards."""
    n, planes, groups = packed.shape
    total = np.zeros((n, tables.shape[2]), dtype=tables.dtype)
    held = np.empty_like(total)
    for plane in reversed(range(planes)):
        total += total
        for group in range(groups):
            np.take(tables[group], packed[:, plane, group], axis=0, out=held)
            if plane == planes - 1:
                total -= held
            else:
                total += held
    return total


class Best:
    """The ``k`` best rows of each owner: highest score, then smaller id."""

    def __init__(self, owners: int, k: int):
        self.k = k
        self.score = np.full((owners, k), NONE, dtype=np.int64)
        self.id = np.full((owners, k), np.iinfo(np.int64).max, dtype=np.int64)

    def offer(self, first: int, ids: np.ndarray, scores: np.ndarray) -> None:
        """Scores (row, owner) of owners ``first`` on; ``NONE`` is no offer."""
        owners = slice(first, first + scores.shape[1])
        last, last_id = self.score[owners, -1][None, :], self.id[owners, -1][None, :]
        wanted = (scores > last) | ((scores == last) & (ids[:, None] < last_id))
        wanted &= scores != NONE
        if len(ids) > self.k:
            wanted &= scores >= np.partition(scores, len(ids) - self.k, axis=0)[len(ids) - self.k][None, :]
        row, column = np.nonzero(wanted)
        if not len(row):
            return
        owner = column + first
        touched = np.unique(owner)
        owner = np.concatenate((owner, np.repeat(touched, self.k)))
        score = np.concatenate((scores[row, column], self.score[touched].ravel()))
        ident = np.concatenate((ids[row], self.id[touched].ravel()))
        order = np.lexsort((ident, -score, owner))
        owner = owner[order]
        place = np.arange(len(owner)) - np.searchsorted(owner, owner)
        kept = place < self.k
        self.score[owner[kept], place[kept]] = score[order][kept]
        self.id[owner[kept], place[kept]] = ident[order][kept]

    def rows(self) -> pa.RecordBatch:
        owner, place = np.nonzero(self.score != NONE)
        columns = [owner.astype(np.int64), self.id[owner, place], self.score[owner, place]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["owner", "id", "score"])


@dataclass
class Anchors:
    """A block of anchors; ``low`` and ``high`` are the ranges (place, anchor) of the second pass."""

    id: np.ndarray
    label: np.ndarray
    packed: np.ndarray
    low: np.ndarray | None = None
    high: np.ndarray | None = None


def _planes(planes: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            packed = pack_planes(flat.reshape(batch.num_rows, -1), planes).reshape(batch.num_rows, -1)
            if not packed.shape[1]:
                packed = np.zeros((batch.num_rows, planes), dtype=np.uint8)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), binary_rows(packed)], ["id", "label", "planes"]
            )

    return pack


def _unpacked(batch: pa.RecordBatch, planes: int) -> np.ndarray:
    raw = np.frombuffer(b"".join(batch.column("planes").to_pylist()), dtype=np.uint8)
    return raw.reshape(batch.num_rows, planes, -1)


def _best_of(anchors: Anchors, planes: int, k: int):
    """Best rows of each anchor; with ranges, of each anchor and range (owner ``place * n + anchor``)."""

    def best_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(anchors.id)
        ranges = 1 if anchors.low is None else len(anchors.low)
        best = Best(ranges * n, k)
        components = unpack_planes(anchors.packed)
        # Sums of a group and scores fit 32 bits where the components are small.
        size = max(1, int(np.abs(components).max(initial=0)), 1 << (planes - 1))
        kind = np.int32 if size * size * components.shape[1] < 1 << 30 else np.int64
        for batch in batches:
            packed = _unpacked(batch, planes)
            ids, labels = batch.column("id").to_numpy(), batch.column("label").to_numpy()
            for first in range(0, n, TABLES):
                own = slice(first, first + TABLES)
                tables = subset_sums(components[own]).astype(kind)
                for start in range(0, len(ids), ROWS):
                    rows = slice(start, start + ROWS)
                    scores = inner_products(tables, packed[rows]).astype(np.int64)
                    same = labels[rows, None] == anchors.label[None, own]
                    if anchors.low is None:
                        allowed = same & (ids[rows, None] != anchors.id[None, own])
                        best.offer(first, ids[rows], np.where(allowed, scores, NONE))
                        continue
                    for place in range(ranges):
                        allowed = ~same & (scores >= anchors.low[place, own]) & (scores <= anchors.high[place, own])
                        best.offer(place * n + first, ids[rows], np.where(allowed, scores, NONE))
        yield best.rows()

    return best_of


def _merged(stored: DataFrame, anchors: Anchors, planes: int, k: int) -> DataFrame:
    """``owner, id, score, rank`` of the ``k`` best rows over all tasks."""
    order = Window.partitionBy("owner").orderBy(F.desc("score"), "id")
    found = stored.mapInArrow(_best_of(anchors, planes, k), "owner long, id long, score long")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _mine_block(stored: DataFrame, anchors: Anchors, planes: int, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    spark, n = stored.sparkSession, len(anchors.id)
    near = _merged(stored, anchors, planes, positives)
    # At most ``positives`` rows for each anchor of the block.
    near = near.select("owner", "id", "score", "rank").toPandas()
    place = near["rank"].to_numpy() - 1
    anchor, score = near["owner"].to_numpy(), near["score"].to_numpy()
    anchors.low, anchors.high = np.full((positives, n), 1, np.int64), np.full((positives, n), 0, np.int64)
    # Whole numbers throughout: low * p <= 100 * score <= high * p.
    anchors.low[place, anchor] = [-((-low * int(p)) // 100) for p in score]
    anchors.high[place, anchor] = [(high * int(p)) // 100 for p in score]
    known = spark.createDataFrame(
        list(
            zip(
                (place * n + anchor).tolist(),
                anchors.id[anchor].tolist(),
                near["id"].tolist(),
                score.tolist(),
            )
        ),
        "owner long, anchor_id long, positive_id long, positive_score long",
    )
    found = _merged(stored, anchors, planes, negatives)
    return found.join(F.broadcast(known), "owner").select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


SCHEMA = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine_negatives(
    vectors: DataFrame,
    every: int = 100,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    block: int = ANCHORS,
) -> DataFrame:
    """Hard negatives for frames of ``id, label, vector``; anchors are the ids ``every`` divides."""
    spark = vectors.sparkSession
    whole = freeze(usable(vectors), "whole-vectors")
    size = F.transform("vector", lambda v: F.when(v < 0, F.bitwise_not(v)).otherwise(v))
    lengths = whole.groupBy(F.size("vector").alias("length")).agg(F.coalesce(F.max(F.array_max(size)), F.lit(0)).alias("top"))
    found = None
    # One pass for each vector length that occurs.
    for length, top in sorted(map(tuple, lengths.collect())):
        planes = int(top).bit_length() + 1
        own = whole.where(F.size("vector") == length)
        # As many tasks as cores: each of them sends the best rows of every anchor.
        own = own.mapInArrow(_planes(planes), "id long, label long, planes binary")
        stored = freeze(own.repartition(spark.sparkContext.defaultParallelism), "bit-planes")
        asked = freeze(stored.where(F.col("id") % every == 0).distinct(), "anchors")
        parts = math.ceil(asked.count() / block)
        for part in range(parts):
            rows = asked.where(F.pmod(F.xxhash64("id", "label", "planes"), F.lit(parts)) == part).toArrow()
            if not rows.num_rows:
                continue
            batch = rows.combine_chunks().to_batches()[0]
            anchors = Anchors(
                batch.column("id").to_numpy(), batch.column("label").to_numpy(), _unpacked(batch, planes)
            )
            mined = freeze(_mine_block(stored, anchors, planes, positives, negatives, low, high), "hard-negatives")
            found = mined if found is None else found.unionByName(mined)
    return spark.createDataFrame([], SCHEMA) if found is None else found


def mine_embeddings(embeddings: DataFrame) -> DataFrame:
    """Hard negatives of ``embeddings``; where 7 divides the id, the label is the next of ten."""
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return mine_negatives(
        embeddings.select(F.col("vec_id").alias("id"), moved.alias("label"), F.col("embedding").alias("vector"))
    )
