"""Exact top-k search over binary codes by incremental multi-index hashing.

A vector's code is the signs of its components. Codes are cut into segments of at least
``log2`` of the number of different codes in bits, so that a segment value is held by one
code on average however many there are, and every segment is a hash index. For radius 0, 1, …
the segment values at that radius from a query's are looked up, from radius 2 on in two
steps of half the segments each. After radius ``s`` in the first ``a`` segments, and
``s - 1`` in the others, every code within ``s * segments + a - 1`` bits has been met, so a
query is finished once its k-th verified distance is within that bound.

Equal codes are one entry with the ``k`` least ids, and equal queries are one query. A code
met in several segments counts at its nearest segment only. A query is answered from the
vectors of its own length, by an index for each length that queries have. Null and empty
vectors are neither found nor answered; a null component counts as not positive. Ties go by
id. With fewer than ``k`` vectors all of them are returned; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermart.llm.common import binary_rows
from ordermart.session import freeze

K = 10


def _codes(bits: int):
    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector")
            flat = pc.fill_null(pc.list_flatten(vectors), 0.0).to_numpy().reshape(-1, bits)
            packed = np.packbits(flat > 0, axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("id"), binary_rows(packed)], ["id", "code"])

    return codes


def _segments(bits: int, limits: list[int]):
    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.frombuffer(b"".join(batch.column("code").to_pylist()), dtype=np.uint8)
            signs = np.unpackbits(raw.reshape(batch.num_rows, -1), axis=1)[:, :bits].astype(np.int64)
            values = [
                signs[:, a:b] @ (1 << np.arange(b - a, dtype=np.int64)) for a, b in zip(limits[:-1], limits[1:])
            ]
            flat = np.stack(values, axis=1).astype(np.int32).ravel()
            offsets = np.arange(batch.num_rows + 1, dtype=np.int32) * len(values)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                [*batch.schema.names, "segments"],
            )

    return segments


def _probes(widths: list[int], radius: int, chosen: range):
    """Rows of every query and segment value exactly ``radius`` bits from the query's."""

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = [
            np.array([sum(1 << b for b in flipped) for flipped in combinations(range(w), radius)], dtype=np.int32)
            for w in widths
        ]
        for batch in batches:
            flat = pc.list_flatten(batch.column("segments")).to_numpy().reshape(-1, len(widths))
            for segment in chosen:
                mask = masks[segment]
                # A few queries at a time, so that a batch of probes stays small.
                for low in range(0, len(flat), 256):
                    own = flat[low : low + 256, segment]
                    row = pa.array(np.repeat(np.arange(low, low + len(own)), len(mask)))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(row), segment, dtype=np.int32)),
                            pa.array((own[:, None] ^ mask[None, :]).ravel()),
                            pc.take(batch.column("query"), row),
                            pc.take(batch.column("segments"), row),
                        ],
                        ["segment", "value", "query", "wanted"],
                    )

    return probes


def _steps(widths: list[int]) -> list[tuple[int, range]]:
    """Radius and segments of each step, by increasing radius."""
    n = len(widths)
    whole, halves = [range(n)], [r for r in (range(n // 2), range(n // 2, n)) if len(r)]
    return [(radius, r) for radius in range(max(widths) + 1) for r in (whole if radius < 2 else halves)]


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """``query_id, rank, id, distance`` for frames of ``id`` and ``vector``.

    Vectors of each length are searched among their own, with an index for each length.
    """
    asked = queries.where(F.size("vector") > 0).select(F.size("vector").alias("bits")).distinct()
    found = None
    for bits in sorted(row.bits for row in asked.collect()):
        own = _top_k_of_length(vectors, queries, bits, k)
        found = own if found is None else found.unionByName(own)
    if found is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, id long, distance int")
    return found


def _top_k_of_length(vectors: DataFrame, queries: DataFrame, bits: int, k: int) -> DataFrame:
    def coded(df: DataFrame) -> DataFrame:
        whole = df.where(F.col("vector").isNotNull() & (F.size("vector") == bits))
        return whole.select("id", F.col("vector").cast("array<float>").alias("vector")).mapInArrow(
            _codes(bits), "id long, code binary"
        )

    least = Window.partitionBy("code").orderBy("id")
    kept = coded(vectors).withColumn("place", F.row_number().over(least)).where(F.col("place") <= k)
    entries = freeze(kept.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")), "codes")
    asked = freeze(coded(queries).select(F.col("id").alias("query_id"), "code"), "queries")

    n = entries.count()
    # Segments of at least log2(n) bits: a value is held by one code or fewer on average.
    segments = max(1, min(bits, int(bits / max(1.0, math.log2(max(n, 2))))))
    limits = [round(j * bits / segments) for j in range(segments + 1)]
    widths = [b - a for a, b in zip(limits[:-1], limits[1:])]
    cut = _segments(bits, limits)
    index = freeze(
        entries.select("code", F.col("ids")[0].alias("least_id"), F.size("ids").alias("n_ids"))
        .mapInArrow(cut, "code binary, least_id long, n_ids int, segments array<int>")
        .select("code", "least_id", "n_ids", "segments", F.posexplode("segments").alias("segment", "value")),
        "segment-index",
    )
    active = freeze(
        asked.select("code").distinct().mapInArrow(cut, "code binary, segments array<int>").select(
            F.col("code").alias("query"), "segments"
        ),
        "active",
    )
    best = None
    best_of = Window.partitionBy("query").orderBy("distance", "least_id")
    for radius, chosen in _steps(widths):
        apart = F.zip_with("wanted", "segments", lambda a, b: F.bit_count(a.bitwiseXOR(b)))
        met = (
            active.mapInArrow(_probes(widths, radius, chosen), "segment int, value int, query binary, wanted array<int>")
            # Spark takes the probes to be as few as the queries; they must not be broadcast.
            .hint("merge")
            .join(index, ["segment", "value"])
            .withColumn("apart", apart)
            .where(
                (F.array_min("apart") == radius)
                & (F.array_position("apart", F.lit(radius)) == F.col("segment") + 1)
            )
            .select(
                "query",
                "code",
                "least_id",
                "n_ids",
                F.aggregate("apart", F.lit(0), lambda total, x: total + x).alias("distance"),
            )
        )
        found = met if best is None else best.unionByName(met)
        ranked = found.withColumn("place", F.row_number().over(best_of)).where(F.col("place") <= k).drop("place")
        best = freeze(ranked, "best")
        bound = radius * segments + chosen.stop - 1
        covered = best.where(F.col("distance") <= bound).groupBy("query").agg(F.sum("n_ids").alias("n"))
        done = covered.where(F.col("n") >= k).select("query")
        active = freeze(active.join(done, "query", "left_anti"), "active")
        if active.isEmpty():
            break
    order = Window.partitionBy("query").orderBy("distance", "id")
    answers = (
        best.join(entries, "code")
        .select("query", "distance", F.explode("ids").alias("id"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
    )
    return asked.join(answers, asked["code"] == answers["query"]).select("query_id", "rank", "id", "distance")


def search_embeddings(embeddings: DataFrame, k: int = K, every: int = 100) -> DataFrame:
    """``query_id, rank, vec_id, distance``: the rows whose id ``every`` divides, against all rows."""
    vectors = embeddings.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").alias("vector"))
    found = exact_top_k(vectors, vectors.where(F.col("id") % every == 0), k)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "distance")
