"""Self-join of documents on the Jaccard similarity of their word n-grams.

1. Documents of equal words form a class; only one text of each class goes on.
2. A MinHash signature is cut into bands; numbers of bands and rows are chosen so that a
   pair at the threshold shares a band with the target probability. Classes that share a
   band hash are tied to the least of them, never to each other, and the ties' connected
   components are the candidate clusters.
3. Inside a cluster every pair is verified on its full n-gram sets, cluster by cluster as
   products of membership matrices. A cluster beyond ``CHUNK`` texts or bytes is cut into
   chunks and each pair of chunks is a task of its own, so nothing unbounded meets in one
   task and no pair is left out. Pairs are counted and joined into classes there; they are
   never emitted.

A document of fewer than ``n`` words has one n-gram of all its words. Documents without
words (null, empty, only signs) are linked to nothing; equal ones are copies. Links count
different texts, so texts that differ only in case or signs are linked too. Repeated rows
are copies. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.llm.common import (
    as_one_column,
    binary_rows,
    blocks,
    mix,
    runs_of_words,
    signed,
    text_key,
    text_of,
    words,
)
from ordermart.llm.components import connected_components
from ordermart.operators.keys import assign_surrogate_keys
from ordermart.session import freeze
from ordermart.sinks.tables import by_rows

NGRAM = 5
THRESHOLD = 0.8
RECALL = 0.9995
MAX_HASHES = 160
# Texts and bytes of text of a cluster that meet in one task, at most twice as many.
CHUNK = 512
CHUNK_BYTES = 16 << 20
CELL_BYTES = 4 << 20
COLUMNS = 4096


def bands_and_rows(threshold: float = THRESHOLD, recall: float = RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """Most rows per band, hence fewest false candidates, whose bands reach the recall."""
    best = None
    for rows in range(1, max_hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows)) if threshold < 1 else 1
        if bands * rows <= max_hashes:
            best = bands, rows
    if best is None:
        raise ValueError("the recall needs more hashes than allowed")
    return best


def _seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    values = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (values[:n] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (values[n:] >> np.uint64(32)).astype(np.uint32)


def signatures(grams: np.ndarray, bounds: np.ndarray, n_hashes: int) -> np.ndarray:
    """Least hash of every row's n-grams under each permutation; rows without n-grams get 0."""
    a, b = _seeds(n_hashes)
    out = np.zeros((len(bounds) - 1, n_hashes), dtype=np.uint32)
    filled = np.flatnonzero(np.diff(bounds))
    if len(filled):
        short = (grams >> np.uint64(32)).astype(np.uint32)
        starts = bounds[filled]
        for k in range(n_hashes):
            out[filled, k] = np.minimum.reduceat(short * a[k] + b[k], starts)
    return out


def band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.zeros((len(signature), bands), dtype=np.uint64)
    for band in range(bands):
        value = np.full(len(signature), band + 1, dtype=np.uint64)
        for k in range(band * rows, (band + 1) * rows):
            value = mix(value ^ signature[:, k].astype(np.uint64), k)
        out[:, band] = value
    return out


def _sign(n: int, bands: int, rows: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, lists, counts = [], [], []
            for block in blocks(batch.column("text")):
                found = words(block)
                hashed = found.hashes()
                grams, bounds = runs_of_words(hashed, found.first, n)
                signature = signatures(grams, bounds, bands * rows)
                lists.append(signed(band_hashes(signature, bands, rows)))
                counts.append(np.diff(found.first))
                # Digest of the word sequence: sums over words, mixed with their positions.
                place = (np.arange(len(hashed)) - found.first[found.row]).astype(np.uint64)
                sums = [
                    np.concatenate(([np.uint64(0)], np.cumsum(mix(hashed ^ mix(place, seed), seed))))
                    for seed in (1, 2)
                ]
                keys.append(np.stack([s[found.first[1:]] - s[found.first[:-1]] for s in sums], axis=1))
            n_rows = batch.num_rows
            flat = np.concatenate(lists).ravel() if lists else np.zeros(0, np.int64)
            offsets = pa.array(np.arange(n_rows + 1, dtype=np.int32) * bands)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    binary_rows(np.concatenate(keys)) if keys else pa.array([], pa.binary()),
                    pa.array(np.concatenate(counts) if counts else [], pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(flat)),
                ],
                ["doc_id", "text_key", "word_key", "n_words", "bands"],
            )

    return sign


def verified_links(members: list[np.ndarray], weight: np.ndarray, threshold: float, side: np.ndarray, across: bool) -> tuple:
    """Weighted links and least linked-to member of every set.

    ``members`` are sorted arrays of different n-grams. With ``across`` only
    pairs of different ``side`` are looked at: none where one side is empty.
    """
    n = len(members)
    size = np.array([len(m) for m in members], dtype=np.int64)
    owner = np.repeat(np.arange(n), size)
    grams, column, count = np.unique(np.concatenate(members), return_inverse=True, return_counts=True)
    # An n-gram of a single set is in no intersection.
    shared = count > 1
    renumber = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column = owner[keep], renumber[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((n, n), dtype=np.float32)
    for low in range(0, int(shared.sum()), COLUMNS):
        a, b = np.searchsorted(column, [low, low + COLUMNS])
        matrix = np.zeros((n, COLUMNS), dtype=np.float32)
        matrix[owner[a:b], column[a:b] - low] = 1
        common += matrix @ matrix.T
    union = size[:, None] + size[None, :] - common
    linked = common >= threshold * union - 1e-9
    if across:
        linked &= side[:, None] != side[None, :]
    np.fill_diagonal(linked, False)
    label = np.arange(n)
    while True:
        least = np.minimum(label, np.where(linked, label[None, :], n).min(axis=1))
        least = least[least]
        if (least == label).all():
            break
        label = least
    return linked @ weight, label


LINKED = "node long, root long, links long, big boolean"


def _verify(n: int, threshold: float):
    def verify(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        sets: list[np.ndarray] = []
        for block in blocks(table.column("text")):
            found = words(block)
            grams, bounds = runs_of_words(found.hashes(), found.first, n)
            sets += [np.unique(grams[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
        cluster = table.column("cluster").to_numpy()
        node = table.column("node").to_numpy()
        weight = table.column("n_texts").to_numpy()
        side = table.column("side").to_numpy()
        chunk, other = table.column("i").to_numpy(), table.column("j").to_numpy()
        big = chunk >= 0
        order = np.lexsort((node, cluster))
        cuts = np.flatnonzero(np.diff(cluster[order])) + 1
        roots, links = node.copy(), np.zeros(len(node), dtype=np.int64)
        for group in np.split(order, cuts):
            if len(group) > 1:
                across = chunk[group[0]] < other[group[0]]
                got, label = verified_links([sets[k] for k in group], weight[group], threshold, side[group], across)
                links[group], roots[group] = got, node[group[label]]
        return pa.table({"node": node, "root": roots, "links": links, "big": big})

    return verify


def near_copies(
    docs: DataFrame, n: int = NGRAM, threshold: float = THRESHOLD, recall: float = RECALL
) -> tuple[DataFrame, DataFrame]:
    """Rows ``doc_id, word_key``, and what holds for all rows of equal words.

    The second frame has ``word_key, class_key, n_links, n_copies, stands_for``.
    ``class_key`` numbers the classes: texts joined by chains of links. ``n_links`` counts
    the different texts linked to one, ``n_copies`` the rows of equal words, and
    ``stands_for`` is the least ``first_doc`` (``doc_id``) and ``text_key`` among them.
    """
    bands, rows = bands_and_rows(threshold, recall)
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), text_of().alias("text")
    )
    signed_rows = freeze(
        source.mapInArrow(
            _sign(n, bands, rows),
            "doc_id long, text_key binary, word_key binary, n_words long, bands array<long>",
        ).withColumn("word_key", F.when(F.col("n_words") > 0, F.col("word_key")).otherwise(F.col("text_key"))),
        "signatures",
    )
    # Copies fall together map-side: first by text, then by words.
    texts = signed_rows.groupBy("word_key", "text_key").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("doc_id").alias("first_doc"),
        F.max("n_words").alias("n_words"),
        F.first("bands").alias("bands"),
    )
    classes = texts.groupBy("word_key").agg(
        F.count(F.lit(1)).alias("n_texts"),
        F.sum("n_rows").alias("n_copies"),
        F.min_by(
            F.struct("first_doc", "text_key"), F.struct(F.col("first_doc").isNull(), "first_doc", "text_key")
        ).alias("stands_for"),
        F.max("n_words").alias("n_words"),
        F.first("bands").alias("bands"),
    )
    classes = freeze(assign_surrogate_keys(classes, "node", ["word_key"]), "classes")

    banded = classes.where("n_words > 0").select("node", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least < most")
    # A side is sized as if a list had one element, and would be broadcast with all its bands.
    ties = banded.join(shared.hint("merge"), "band").select(F.col("node").alias("a"), F.col("least").alias("b"))
    clusters = freeze(connected_components(ties), "clusters")

    wanted = (
        classes.join(by_rows(clusters), "node")
        .select("node", F.col("root").alias("cluster"), "n_texts", "stands_for.first_doc", "stands_for.text_key")
    )
    candidates = freeze(
        source.hint("merge")
        .join(wanted, (source["text_key"] == wanted["text_key"]) & source["doc_id"].eqNullSafe(wanted["first_doc"]))
        .select("node", "cluster", "n_texts", "text")
        .dropDuplicates(["node"]),
        "candidate-texts",
    )
    width = F.octet_length("text")
    total = candidates.agg(F.sum(width)).first()[0] or 0
    cells = max(32, math.ceil(total / CELL_BYTES))
    sizes = candidates.groupBy("cluster").agg(
        F.ceil(F.greatest(F.count(F.lit(1)) / CHUNK, F.sum(width) / CHUNK_BYTES)).cast("int").alias("chunks")
    )
    sized = candidates.join(sizes, "cluster").withColumn(
        "chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    )
    small = sized.where("chunks = 1").select(
        F.pmod(F.xxhash64("cluster"), F.lit(cells)).alias("cell"),
        F.lit(-1).alias("i"),
        F.lit(-1).alias("j"),
        F.lit(0).alias("side"),
        *candidates.columns,
    )
    large = (
        sized.where("chunks > 1")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select(
            F.col("cluster").alias("cell"),
            F.least("chunk", "other").alias("i"),
            F.greatest("chunk", "other").alias("j"),
            (F.col("chunk") > F.col("other")).cast("int").alias("side"),
            *candidates.columns,
        )
    )
    linked = freeze(
        small.unionByName(large).groupBy("cell", "i", "j").applyInArrow(_verify(n, threshold), LINKED), "links"
    )
    linked = by_rows(linked)
    links = linked.groupBy("node").agg(F.sum("links").alias("links"))
    # Within one task the roots are final; over several chunks they are joined once more.
    chunked = connected_components(linked.where("big").select(F.col("node").alias("a"), F.col("root").alias("b")))
    roots = linked.where("NOT big AND node <> root").select("node", "root").unionByName(chunked)
    told = classes.join(links, "node", "left").join(roots, "node", "left").select(
        "word_key",
        F.coalesce("root", "node").alias("class_key"),
        (F.coalesce("links", F.lit(0)) + F.when(F.col("n_words") > 0, F.col("n_texts") - 1).otherwise(0)).alias("n_links"),
        "n_copies",
        "stands_for",
    )
    return signed_rows.select("doc_id", "word_key"), by_rows(freeze(told, "near-copies"), "class_key", "word_key")


def near_duplicate_classes(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, class_id, n_links, n_copies``; a class is named by its least ``doc_id``."""
    rows, told = near_copies(docs, **options)
    named = told.groupBy("class_key").agg(F.min("stands_for.first_doc").alias("class_id"))
    of_words = told.join(named, "class_key").select("word_key", "class_id", "n_links", "n_copies")
    # A hot group of copies meets one row here, so its part of the join can be split.
    return rows.join(of_words, "word_key").select("doc_id", "class_id", "n_links", "n_copies")


def drop_near_copies(docs: DataFrame, **options) -> DataFrame:
    """The row of least ``doc_id`` of every class, with all columns of ``docs``."""
    _, told = near_copies(docs, **options)
    # Ids that are null come last.
    order = F.struct(F.col("stands_for.first_doc").isNull(), "stands_for.first_doc", "stands_for.text_key")
    first = told.groupBy("class_key").agg(F.min_by("stands_for", order).alias("kept"))
    kept = first.select(F.col("kept.first_doc").alias("kept_id"), F.col("kept.text_key").alias("kept_key"))
    # The documents travel as one column, so their names meet no others.
    keyed = docs.select(as_one_column(docs), text_key().alias("key"))
    same = (F.col("key") == F.col("kept_key")) & F.col("row.doc_id").eqNullSafe(F.col("kept_id"))
    # Rows equal in id and text are copies too.
    return keyed.join(kept, same).dropDuplicates(["kept_key", "kept_id"]).select("row.*")
