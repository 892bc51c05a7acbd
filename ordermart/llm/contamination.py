"""Benchmark decontamination over a positional inverted index of the training words.

``build_index`` reads the documents once and stores, for every document, its number of
words and the postings (term, position) that a benchmark phrase could use: words that are
benchmark terms and stand in a run of such words long enough for the shortest phrase. All
other postings can take part in no match, so leaving them out loses nothing.

``find_matches`` takes each phrase's rarest term (fewest stored postings), joins only those
posting lists with the phrases, adjusts them by the term's offset, and confirms the other
terms on the document's stored positions: exact phrases, or with ``slop`` phrases whose
words come in order with up to so many other words between them.

The benchmark is handled in blocks of at most ``BLOCK_TOKENS`` words, so what is sent to
every task is bounded however large the benchmark is; each block reads the documents again.

A phrase is ``window`` consecutive words of an item; an item of fewer words, but not none,
is one phrase. Null and empty texts have no words. Documents of equal text are matched once
and each gets the result. Items with equal id and text count once; a null item id counts
but is not listed. Without documents or items the result has no matches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.llm.common import as_one_column, blocks, signed, text_key, text_of, words
from ordermart.session import freeze

BLOCK_TOKENS = 2_000_000
WINDOW = 10
INDEX = "doc_id long, key binary, n_words long, block int, terms array<long>, positions array<int>"


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        terms = []
        for block in blocks(batch.column("text")):
            found = words(block)
            hashed = signed(found.hashes())
            terms += [hashed[a:b] for a, b in zip(found.first[:-1], found.first[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column("item_id"), pa.array(terms, pa.list_(pa.int64()))], ["item_id", "terms"]
        )


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """``item, block, terms, names, ids``: different texts of items, dealt into blocks.

    Items of the same words are one entry, however many there are: ``names`` counts them and
    ``ids`` are their ids as text, sorted, without null.
    """
    named = (
        benchmark.select("item_id", text_of().alias("text"))
        .distinct()
        .mapInArrow(_item_terms, "item_id long, terms array<long>")
        .where(F.size("terms") > 0)
        .distinct()
    )
    ids = F.array_sort(F.collect_set(F.col("item_id").cast("string")))
    items = freeze(
        named.groupBy("terms")
        .agg(F.count(F.lit(1)).alias("names"), ids.alias("ids"))
        .withColumn("item", F.xxhash64("terms")),
        "benchmark-items",
    )
    tokens = items.agg(F.sum(F.size("terms"))).first()[0] or 0
    n_blocks = -(-tokens // BLOCK_TOKENS)
    return items.withColumn("block", F.pmod("item", F.lit(max(1, n_blocks))).cast("int"))


def _long_runs(positions: np.ndarray, row: np.ndarray, least: int, slop: int) -> np.ndarray:
    """Which of the sorted positions stand in a run of at least ``least``."""
    if not len(positions):
        return np.zeros(0, dtype=bool)
    starts = np.ones(len(positions), dtype=bool)
    starts[1:] = (row[1:] != row[:-1]) | (np.diff(positions) > slop + 1)
    length = np.diff(np.append(np.flatnonzero(starts), len(positions)))
    return np.repeat(length >= least, length)


def _postings(vocabulary: np.ndarray, least: int, slop: int, number: int):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, terms, positions = [], [], []
            for block in blocks(batch.column("text")):
                found = words(block)
                hashed = signed(found.hashes())
                slot = np.minimum(np.searchsorted(vocabulary, hashed), max(len(vocabulary) - 1, 0))
                known = np.flatnonzero(vocabulary[slot] == hashed) if len(vocabulary) else slot[:0]
                known = known[_long_runs(known, found.row[known], least, slop)]
                cut = np.searchsorted(found.row[known], np.arange(len(block) + 1))
                counts.append(np.diff(found.first))
                place = known - found.first[found.row[known]]
                terms += [hashed[known[a:b]] for a, b in zip(cut[:-1], cut[1:])]
                positions += [place[a:b] for a, b in zip(cut[:-1], cut[1:])]
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("key"),
                    pa.array(np.concatenate(counts) if counts else [], pa.int64()),
                    pa.array(np.full(n, number), pa.int32()),
                    pa.array(terms, pa.list_(pa.int64())),
                    pa.array(positions, pa.list_(pa.int32())),
                ],
                ["doc_id", "key", "n_words", "block", "terms", "positions"],
            )

    return index


def block_numbers(items: DataFrame) -> list[int]:
    """One number per ``BLOCK_TOKENS`` benchmark words; block 0 is there even without items."""
    return sorted({0, *(row.block for row in items.select("block").distinct().collect())})


def build_index(docs: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """Stored postings: a row per document and benchmark block, see ``INDEX``."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"), text_of().alias("text"))
    parts = []
    for number in block_numbers(items):
        own = items.where(F.col("block") == number)
        # Both bounded by BLOCK_TOKENS.
        known = own.select(F.explode("terms").alias("term")).distinct().toPandas()["term"]
        least = own.agg(F.least(F.min(F.size("terms")), F.lit(window))).first()[0] or window
        vocabulary = np.sort(known.to_numpy(np.int64))
        parts.append(source.mapInArrow(_postings(vocabulary, least, slop, number), INDEX))
    return freeze(reduce(DataFrame.unionByName, parts), "postings")


def _phrases(items: DataFrame, window: int) -> DataFrame:
    """A row per phrase and word: ``block, item, phrase, at, term``; ``at`` counts in the item."""
    last = F.greatest(F.size("terms") - window, F.lit(0))
    return items.select("block", "item", "terms", F.explode(F.sequence(F.lit(0), last)).alias("phrase")).select(
        "block",
        "item",
        "phrase",
        F.posexplode(F.slice("terms", F.col("phrase") + 1, window)).alias("within", "term"),
    ).select("block", "item", "phrase", (F.col("phrase") + F.col("within")).alias("at"), "term")


def rarest_terms(items: DataFrame, postings: DataFrame, window: int = WINDOW) -> DataFrame:
    """``block, item, at, term``: for every phrase that can occur its rarest term."""
    size = postings.groupBy("block", "term").agg(F.count(F.lit(1)).alias("postings"))
    phrases = _phrases(items, window).join(size, ["block", "term"], "left")
    return (
        phrases.groupBy("block", "item", "phrase")
        .agg(
            F.min_by(F.struct("at", "term"), F.struct("postings", "at")).alias("rarest"),
            F.bool_and(F.col("postings").isNotNull()).alias("possible"),
        )
        .where("possible")
        .select("block", "item", "rarest.at", "rarest.term")
        .distinct()
    )


def exact_hits(where: np.ndarray, at: np.ndarray, start: int, item: np.ndarray, window: int) -> np.ndarray:
    """Positions of phrases of ``item`` that stand in full with the item's first word at ``start``."""
    n = min(window, len(item))
    wanted = start + np.arange(len(item))
    slot = np.minimum(np.searchsorted(where, wanted), len(where) - 1)
    same = (where[slot] == wanted) & (at[slot] == item)
    total = np.concatenate(([0], np.cumsum(same)))
    begins = np.flatnonzero(total[n:] - total[:-n] == n)
    return np.unique((begins[:, None] + np.arange(n)).ravel()) + start


def near_hits(
    where: np.ndarray, at: np.ndarray, lead: int, place: int, item: np.ndarray, window: int, slop: int
) -> np.ndarray:
    """Positions of phrases around a posting, in order, with at most ``slop`` words between."""
    n = min(window, len(item))
    lists = {int(term): where[at == term] for term in np.unique(item)}
    hits: list[int] = []
    for phrase in range(max(0, lead - n + 1), min(lead, len(item) - n) + 1):
        terms = item[phrase : phrase + n]
        first = lists[int(terms[0])]
        for begin in first[(first >= place - n - slop) & (first <= place)]:
            chain = [int(begin)]
            for term in terms[1:]:
                found = lists[int(term)]
                nxt = np.searchsorted(found, chain[-1], side="right")
                if nxt == len(found) or found[nxt] - begin >= n + slop:
                    break
                chain.append(int(found[nxt]))
            if len(chain) == n:
                hits += chain
    return np.unique(np.asarray(hits, dtype=np.int64))


MATCHED = "key binary, positions array<int>, items array<long>"


def _confirm(terms_of: dict[int, np.ndarray], window: int, slop: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, hit, items = [], [], []
            for row in batch.to_pylist():
                where = np.asarray(row["positions"], dtype=np.int64)
                at = np.asarray(row["terms"], dtype=np.int64)
                covered: set[int] = set()
                found: set[int] = set()
                done = set()
                for place in row["places"]:
                    item = terms_of[place["item"]]
                    start = place["position"] - place["at"]
                    mark = (place["item"], start, place["at"] if slop else 0)
                    if mark in done:
                        continue
                    done.add(mark)
                    if slop:
                        got = near_hits(where, at, place["at"], place["position"], item, window, slop)
                    else:
                        got = exact_hits(where, at, start, item, window)
                    if len(got):
                        covered.update(got.tolist())
                        found.add(place["item"])
                if found:
                    keys.append(row["key"])
                    hit.append(sorted(covered))
                    items.append(sorted(found))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.binary()),
                    pa.array(hit, pa.list_(pa.int32())),
                    pa.array(items, pa.list_(pa.int64())),
                ],
                ["key", "positions", "items"],
            )

    return confirm


def find_matches(index: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """``key, positions, items`` of every different text with a match; positions count words.

    ``items`` are entries of the benchmark, each of which stands for all items of its words.
    """
    # One row per text, block and index row; copies of a text fall together before the shuffle.
    stored = index.where(F.size("terms") > 0).groupBy("block", "key").agg(
        F.first("terms").alias("terms"), F.first("positions").alias("positions")
    )
    stored = freeze(stored, "postings-of-texts")
    postings = stored.select(
        "block", "key", F.explode(F.arrays_zip("terms", "positions")).alias("posting")
    ).select("block", "key", F.col("posting.terms").alias("term"), F.col("posting.positions").alias("position"))
    # Stored, so that the join sees its size and can split a term with many postings.
    rarest = freeze(rarest_terms(items, postings, window), "rarest-terms")
    places = (
        postings.join(rarest, ["block", "term"])
        .groupBy("block", "key")
        .agg(F.collect_list(F.struct("item", "at", "position")).alias("places"))
    )
    candidates = stored.join(places, ["block", "key"])
    parts = []
    for number in block_numbers(items):
        own = items.where(F.col("block") == number).select("item", "terms").toPandas()
        terms_of = {int(row.item): np.asarray(row.terms, np.int64) for row in own.itertuples()}
        parts.append(
            candidates.where(F.col("block") == number).mapInArrow(_confirm(terms_of, window, slop), MATCHED)
        )
    matched = reduce(DataFrame.unionByName, parts)
    return matched.groupBy("key").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("positions")))).alias("positions"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )


def _named(matched: DataFrame, items: DataFrame) -> DataFrame:
    """``items, n_items, items_sha256`` of every different set of matched entries.

    Many texts share a set, and its items are listed once for all of them.
    """
    sets = matched.select("items").distinct().select("items", F.explode("items").alias("item"))
    return (
        sets.join(items.select("item", "names", "ids"), "item")
        .groupBy("items")
        .agg(F.sum("names").alias("n_items"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("ids"))
        .select("items", "n_items", F.sha2(F.array_join("ids", ","), 256).alias("items_sha256"))
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = 0
) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of every document."""
    items = benchmark_items(benchmark)
    index = build_index(docs, items, window, slop)
    found = freeze(find_matches(index, items, window, slop), "matches")
    named = freeze(_named(found, items), "matched-sets")
    matched = found.join(named, "items").select(
        "key", F.size("positions").cast("long").alias("n_hit"), "n_items", "items_sha256"
    )
    return (
        index.where(F.col("block") == 0)
        .select("doc_id", "key", "n_words")
        .join(matched, "key", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
            F.coalesce("items_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("items_sha256"),
            (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        )
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents that hold no benchmark phrase, with all their columns."""
    items = benchmark_items(benchmark)
    matched = find_matches(build_index(docs, items, window), items, window).select(F.col("key").alias("matched_key"))
    # The documents travel as one column, so their names meet no others.
    keyed = docs.select(as_one_column(docs), text_key().alias("key"))
    return keyed.join(matched, F.col("key") == F.col("matched_key"), "left_anti").select("row.*")
