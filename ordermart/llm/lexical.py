"""Ranked lexical search by hashed max-sketches.

The score of a document adds up, over the terms of an item, the weight of the term times the
term's impact ``1e9 * tf div (1000 * tf + 12 * m)``. For one document the impact only grows
with ``tf``, so a sketch holds term counts: every document folds the counts of its terms
into the cells they hash to, each cell keeping the maximum, in ``ROWS`` independent rows of
``CELLS`` cells for each different term. A sketch knows nothing of the items and serves any
number of them. A count of 255 or more stands for the limit of the impact.

Looking up the terms of a batch of items in a batch of sketches gives, as one matrix
product, an upper bound of every score. The best bounds of each item are scored exactly on
the whole text; the k-th exact score is a threshold, and documents are taken by descending
bound, in growing slices, until no unscored bound reaches it. Nothing is cut off: a slice
bounds only how much is scored before the threshold is raised again.

Items are taken in blocks of ``BLOCK`` (item, term) entries, each block against all
documents. Terms are compared by 64-bit hashes.

Defined results: null and empty texts have no terms, are not counted and never answer.
Rows equal in id and text are one item; an id with several texts has an answer for each.
Every document row counts by itself, repeated rows too; equal scores go by ascending
``doc_id``, null last. An item whose terms no document holds, an empty table of items or of
documents give no rows. Texts of any length are taken whole. Further columns are not read,
so their names cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermart.llm.common import blocks, mix, signed, text_key, text_of, words
from ordermart.session import freeze

K = 20
# Cells of a sketch row for each different term of the document, and rows of a sketch: a term
# that the document lacks meets a filled cell in every row once in 280 times.
CELLS = 6
ROWS = 3
# Highest bounds scored for the first threshold of an item, and those a task contributes, as
# multiples of k.
FIRST, LOCAL = 16, 2
# Lookup tasks for each core, so that what the tasks contribute does not grow with the input.
TASKS = 4
FULL = 255  # a count that is not told apart any more
# (item, term) entries that are looked up at once, and items of one matrix product.
BLOCK = 500_000
GROUP = 64
# Pairs of item and text up to which the texts to score are picked by a broadcast join.
BROADCAST_PAIRS = 1_000_000
# Documents of a batch of lookups times terms, so that its arrays stay small.
LOOKUPS = 1 << 20

_TERM_BITS = 44


def _short(hashes: np.ndarray) -> np.ndarray:
    """The 44 bits of a term's hash that a sketch goes by."""
    return hashes >> np.uint64(64 - _TERM_BITS)


def _cells(short: np.ndarray, row: int) -> np.ndarray:
    """Position of a term in a sketch row, as a fraction of its length in units of 2**-32."""
    return mix(short, row + 1) >> np.uint64(32)


def fold_counts(row: np.ndarray, hashes: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Max-sketches of documents: cells of a sketch row, bounds in the data, and the data.

    ``row`` is the document of each term occurrence. Two terms of a document that share
    44 bits add up their counts, which can only raise the bound.
    """
    key = (row.astype(np.uint64) << np.uint64(_TERM_BITS)) | _short(hashes)
    key.sort()
    at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    count = np.minimum(np.diff(np.append(at, len(key))), FULL).astype(np.uint8)
    owner = (key[at] >> np.uint64(_TERM_BITS)).astype(np.int64)
    short = key[at] & np.uint64((1 << _TERM_BITS) - 1)
    length = CELLS * np.bincount(owner, minlength=n_rows).astype(np.int64)
    bounds = np.concatenate(([0], np.cumsum(ROWS * length)))
    data = np.zeros(int(bounds[-1]), dtype=np.uint8)
    several = count > 1
    for sketch_row in range(ROWS):
        cell = ((_cells(short, sketch_row) * length[owner].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        cell += bounds[owner] + sketch_row * length[owner]
        data[cell[~several]] = np.maximum(data[cell[~several]], 1)
        np.maximum.at(data, cell[several], count[several])
    return length, bounds, data


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch.column("text")):
            found = words(block)
            n = np.diff(found.first)
            _, bounds, data = fold_counts(found.row, found.hashes(), len(block))
            own = pa.array(np.arange(block.first, block.first + len(block)))
            sketch = pa.Array.from_buffers(
                pa.large_binary(), len(block), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data)]
            ).cast(pa.binary())
            rows = pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(own), batch.column("key").take(own), pa.array(n.astype(np.int64)), sketch],
                ["doc_id", "key", "n", "sketch"],
            )
            yield rows.filter(pa.array(n > 0))


def sketch_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, key, n, sketch`` of every document with a term; ``key`` is the text's digest."""
    return _keyed(docs).mapInArrow(_sketches, "doc_id long, key binary, n long, sketch binary")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"), text_of().alias("text"))


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch.column("text")):
            found = words(block)
            order = np.lexsort((found.hashes(), found.row))
            row, value = found.row[order], found.hashes()[order]
            new = np.concatenate(([True], (row[1:] != row[:-1]) | (value[1:] != value[:-1]))) if len(row) else []
            at = np.flatnonzero(new)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("item").take(pa.array(row[at] + block.first)),
                    pa.array(signed(value[at])),
                    pa.array(np.diff(np.append(at, len(row))).astype(np.int64)),
                ],
                ["item", "term", "repeats"],
            )


@dataclass
class Corpus:
    """Counts over all documents: documents with a term, and their terms with repeats."""

    documents: int
    terms: int

    def lengths(self, n: np.ndarray) -> np.ndarray:
        """``m`` of documents of ``n`` terms."""
        return 100 - 25 + (25 * n * self.documents) // self.terms


@dataclass
class ItemBlock:
    """Terms and weights of some items: entry e is of item ``item[e]``."""

    names: list  # key of each item
    vocabulary: np.ndarray  # sorted hashes
    item: np.ndarray
    term: np.ndarray  # place in the vocabulary
    repeats: np.ndarray
    weight: np.ndarray | None = None  # of each term of the vocabulary

    def without_weightless(self) -> ItemBlock:
        """Only the terms that can add to a score."""
        kept = self.weight > 0
        place = np.cumsum(kept) - 1
        entry = kept[self.term]
        return ItemBlock(
            self.names,
            self.vocabulary[kept],
            self.item[entry],
            place[self.term[entry]],
            self.repeats[entry],
            self.weight[kept],
        )

    def groups(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Items, their terms, and the matrix (term, item) of weight times repeats."""
        order = np.argsort(self.item, kind="stable")
        for low in range(0, len(self.names), GROUP):
            a, b = np.searchsorted(self.item[order], [low, low + GROUP])
            own = order[a:b]
            if len(own):
                terms, place = np.unique(self.term[own], return_inverse=True)
                items = np.arange(low, min(low + GROUP, len(self.names)))
                matrix = np.zeros((len(terms), len(items)), dtype=np.int64)
                matrix[place, self.item[own] - low] = self.weight[terms][place] * self.repeats[own]
                yield items, terms, matrix


def _document_counts(vocabulary: np.ndarray):
    """Partial document frequencies of the vocabulary, one set for each task."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary), dtype=np.int64)
        for batch in batches:
            for block in blocks(batch.column("text")):
                found = words(block)
                place, known = _places(vocabulary, found.hashes())
                pairs = np.unique(found.row[known] * np.int64(len(vocabulary)) + place[known])
                total += np.bincount(pairs % len(vocabulary), minlength=len(vocabulary))
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["term", "df"])

    return counts


def _places(vocabulary: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    return place, vocabulary[place] == hashes


def document_frequencies(docs: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """Documents that hold each term of a sorted vocabulary of bounded size."""
    found = np.zeros(len(vocabulary), dtype=np.int64)
    if len(vocabulary):
        partial = docs.select(text_of().alias("text")).mapInArrow(_document_counts(vocabulary), "term long, df long")
        # One row for each term of the vocabulary at most.
        for row in partial.groupBy("term").agg(F.sum("df").alias("df")).collect():
            found[row.term] = row.df
    return found


def _impacts(count: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * count) // (1000 * count + 12 * m)


def upper_bounds(bounds: np.ndarray, data: np.ndarray, m: np.ndarray, hashes: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Upper bounds of the scores of some documents (rows) for some items (columns).

    ``hashes`` are the terms of the rows of ``matrix``. Sums stay below 2**53 for items of up
    to 300,000 terms; a sum beyond is rounded up.
    """
    length = np.diff(bounds) // ROWS
    count = None
    for row in range(ROWS):
        cell = (_cells(_short(hashes), row)[None, :] * length.astype(np.uint64)[:, None]) >> np.uint64(32)
        held = data[cell.astype(np.int64) + (bounds[:-1] + row * length)[:, None]]
        count = held if count is None else np.minimum(count, held)
    by_count = _impacts(np.arange(FULL + 1, dtype=np.int64)[None, :], m[:, None])
    by_count[:, FULL] = 1_000_000
    impact = by_count[np.arange(len(m))[:, None], count].astype(np.float64)
    total = impact @ matrix.astype(np.float64)
    return np.where(total < 2.0**53, total, np.minimum(total * (1 + 1e-9), 2.0**62)).astype(np.int64)


def _lookups(block: ItemBlock, corpus: Corpus, thresholds: np.ndarray | None, k: int):
    """``item, doc_id, key, bound`` with a bound of the item's threshold or more.

    Without thresholds: the k highest bounds of each item in each task.
    """

    def lookups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = [(items, block.vocabulary[terms], matrix) for items, terms, matrix in block.groups()]
        best: dict[int, list] = {}
        for batch in batches:
            sketches = batch.column("sketch")
            _, offsets, raw = sketches.buffers()
            bounds = np.frombuffer(offsets, dtype=np.int32)[sketches.offset : sketches.offset + len(batch) + 1]
            bounds, data = bounds.astype(np.int64), np.frombuffer(raw, dtype=np.uint8)
            m = corpus.lengths(batch.column("n").to_numpy())
            for items, hashes, matrix in groups:
                step = max(1, LOOKUPS // len(hashes))
                for low in range(0, len(batch), step):
                    high = min(low + step, len(batch))
                    bound = upper_bounds(bounds[low : high + 1], data, m[low:high], hashes, matrix)
                    least = 1 if thresholds is None else np.maximum(thresholds[items], 1)[None, :]
                    if thresholds is None and len(bound) > k:
                        least = np.maximum(1, np.partition(bound, len(bound) - k, axis=0)[len(bound) - k][None, :])
                    doc, column = np.nonzero(bound >= least)
                    if not len(doc):
                        continue
                    rows = pa.RecordBatch.from_arrays(
                        [
                            pa.array(items[column].astype(np.int32)),
                            batch.column("doc_id").take(pa.array(doc + low)),
                            batch.column("key").take(pa.array(doc + low)),
                            pa.array(bound[doc, column]),
                        ],
                        ["item", "doc_id", "key", "bound"],
                    )
                    if thresholds is not None:
                        yield rows
                        continue
                    kept = [*best.get(items[0], []), rows]
                    best[items[0]] = [_highest(kept, k)] if len(kept) > 8 else kept
        for kept in best.values():
            yield _highest(kept, k)

    return lookups


def _highest(parts: list[pa.RecordBatch], k: int) -> pa.RecordBatch:
    """Of each item the ``k`` rows of the highest bounds."""
    table = pa.Table.from_batches(parts).combine_chunks()
    item, bound = table.column("item").to_numpy(), table.column("bound").to_numpy()
    order = np.lexsort((-bound, item))
    first = np.searchsorted(item[order], item[order])
    return table.take(pa.array(order[np.arange(len(order)) - first < k])).combine_chunks().to_batches()[0]


def _scores(block: ItemBlock, corpus: Corpus):
    """``item, key, score`` of the wanted items of every text."""

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = np.argsort(block.item, kind="stable")
        first = np.searchsorted(block.item[order], np.arange(len(block.names) + 1))
        for batch in batches:
            wanted = batch.column("items")
            for part in blocks(batch.column("text")):
                found = words(part)
                m = corpus.lengths(np.diff(found.first).astype(np.int64))
                place, known = _places(block.vocabulary, found.hashes())
                out_row, out_item, out_score = [], [], []
                for row in range(len(part)):
                    own = slice(found.first[row], found.first[row + 1])
                    count = np.bincount(place[own][known[own]], minlength=len(block.vocabulary))
                    worth = np.where(count > 0, _impacts(count, m[row]), 0) * block.weight
                    for item in wanted[part.first + row].as_py():
                        entry = order[first[item] : first[item + 1]]
                        out_row.append(part.first + row)
                        out_item.append(item)
                        out_score.append(int(worth[block.term[entry]] @ block.repeats[entry]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(out_item, pa.int32()),
                        batch.column("key").take(pa.array(out_row, pa.int64())),
                        pa.array(out_score, pa.int64()),
                    ],
                    ["item", "key", "score"],
                )

    return scores


def exact_scores(docs: DataFrame, pairs: DataFrame, block: ItemBlock, corpus: Corpus) -> DataFrame:
    """``item, key, score`` of pairs of item and text, from the whole texts.

    Each text is read once, from the document of its least id. The texts move only where the
    pairs are too many to be broadcast.
    """
    wanted = freeze(
        pairs.groupBy("key").agg(F.collect_set("item").alias("items"), F.min("doc_id").alias("least")), "lexical-wanted"
    )
    n = wanted.agg(F.coalesce(F.sum(F.size("items")), F.lit(0))).first()[0]
    wanted = wanted.withColumnRenamed("key", "wanted_key")
    side = F.broadcast(wanted) if n <= BROADCAST_PAIRS else wanted.hint("merge")
    texts = _keyed(docs).join(side, F.col("key") == F.col("wanted_key"))
    texts = texts.where(F.col("doc_id").eqNullSafe(F.col("least"))).select("key", "text", "items")
    scored = texts.mapInArrow(_scores(block, corpus), "item int, key binary, score long")
    # A repeated row of one id and text scores the same again.
    return scored.groupBy("item", "key").agg(F.max("score").alias("score"))


def _least_ids(rows: DataFrame, k: int) -> DataFrame:
    """Of equal texts no more than the ``k`` least ids can be among the k best of an item."""
    window = Window.partitionBy("item", "key").orderBy(F.col("doc_id").asc_nulls_last())
    return rows.withColumn("copy", F.row_number().over(window)).where(F.col("copy") <= k).drop("copy")


def _ranked(met: DataFrame, scores: DataFrame, k: int) -> DataFrame:
    """The ``k`` best scored documents of each item among those met."""
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    rows = met.select("item", "doc_id", "key").join(scores.where(F.col("score") > 0), ["item", "key"])
    return rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _thresholds(best: DataFrame, items: int, k: int) -> np.ndarray:
    """k-th best exact score of each item of the block, 0 where fewer are known."""
    found = np.zeros(items, dtype=np.int64)
    for row in best.where(F.col("rank") == k).select("item", "score").collect():
        found[row.item] = row.score
    return found


def _reaching(rows: DataFrame, thresholds: np.ndarray) -> DataFrame:
    """Rows whose bound reaches the threshold of their item."""
    floor = rows.sparkSession.createDataFrame(
        [(i, int(t)) for i, t in enumerate(thresholds)], "item int, floor long"
    )
    return rows.join(F.broadcast(floor), "item").where(F.col("bound") >= F.col("floor")).drop("floor")


def search_block(docs: DataFrame, sketches: DataFrame, block: ItemBlock, corpus: Corpus, k: int) -> DataFrame:
    """``item, rank, doc_id, score`` of the items of one block."""
    schema = "item int, doc_id long, key binary, bound long"
    first = Window.partitionBy("item").orderBy(F.desc("bound"), F.col("doc_id").asc_nulls_last())
    highest = sketches.mapInArrow(_lookups(block, corpus, None, LOCAL * k), schema)
    highest = highest.withColumn("n", F.row_number().over(first)).where(F.col("n") <= FIRST * k).drop("n")
    met = freeze(highest, "lexical-first")
    scores = freeze(exact_scores(docs, met, block, corpus), "lexical-scores")
    best = freeze(_ranked(met, scores, k), "lexical-best")
    floor = _thresholds(best, len(block.names), k)
    # Every document whose bound reaches the threshold, those scored already among them.
    open_rows = freeze(_least_ids(sketches.mapInArrow(_lookups(block, corpus, floor, k), schema), k), "lexical-open")
    slice_size = 8 * FIRST * k
    while True:
        reaching = _reaching(open_rows, floor)
        unscored = reaching.join(scores.select("item", "key"), ["item", "key"], "left_anti")
        rest = freeze(unscored, "lexical-rest")
        if rest.isEmpty():
            return _ranked(reaching, scores, k)
        part = rest.withColumn("n", F.row_number().over(first)).where(F.col("n") <= slice_size)
        scores = freeze(scores.unionByName(exact_scores(docs, part, block, corpus)), "lexical-scores")
        floor = np.maximum(floor, _thresholds(_ranked(reaching, scores, k), len(block.names), k))
        slice_size *= 8


def _item_key() -> Column:
    name = F.coalesce(F.concat(F.lit("="), F.col("item_id").cast("string")), F.lit("?"))
    return F.unhex(F.md5(F.concat_ws("\n", name, text_of())))


def ranked_search(docs: DataFrame, items: DataFrame, k: int = K, block: int = BLOCK) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents with a score above 0 of each item."""
    spark = docs.sparkSession
    named = freeze(items.select("item_id", _item_key().alias("name"), text_of().alias("text")).distinct(), "lexical-items")
    terms = freeze(
        named.select(F.col("name").alias("item"), "text").mapInArrow(_item_terms, "item binary, term long, repeats long"),
        "lexical-terms",
    )
    sketches = freeze(sketch_documents(docs), "lexical-sketches").coalesce(TASKS * spark.sparkContext.defaultParallelism)
    size = sketches.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    corpus = Corpus(size[0], size[1])
    parts = max(1, math.ceil(terms.count() / block))
    found = None
    for part in range(parts if corpus.documents else 0):
        # About ``block`` entries, or those of one longer item.
        rows = terms.where(F.pmod(F.xxhash64("item"), F.lit(parts)) == part).toPandas()
        if not len(rows):
            continue
        held = _block(rows)
        df = document_frequencies(docs, held.vocabulary)
        weight = [math.floor(1000 * math.log((2 * corpus.documents + 2) / (2 * n + 1))) if n else 0 for n in df.tolist()]
        held.weight = np.array(weight, dtype=np.int64)
        held = held.without_weightless()
        if not len(held.vocabulary):
            continue
        answers = search_block(docs, sketches, held, corpus, k)
        names = spark.createDataFrame([(i, bytearray(n)) for i, n in enumerate(held.names)], "item int, name binary")
        answers = freeze(answers.join(F.broadcast(names), "item"), "lexical-answers")
        found = answers if found is None else found.unionByName(answers)
    if found is None:
        found = spark.createDataFrame([], "name binary, rank int, doc_id long, score long")
    return named.join(found, "name").select("item_id", "rank", "doc_id", "score")


def _block(rows) -> ItemBlock:
    names = sorted({bytes(name) for name in rows["item"]})
    number = {name: i for i, name in enumerate(names)}
    vocabulary, term = np.unique(rows["term"].to_numpy().view(np.uint64), return_inverse=True)
    item = np.array([number[bytes(name)] for name in rows["item"]], dtype=np.int64)
    return ItemBlock(names, vocabulary, item, term, rows["repeats"].to_numpy())
