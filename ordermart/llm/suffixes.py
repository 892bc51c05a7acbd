"""Removal of repeated strings of a minimum length, judged on bytes.

Every byte of a string of ``length`` bytes that also starts anywhere else goes; matches do
not cross documents. The search narrows down before it compares:

1. Each window of ``length`` bytes names the least hashed ``gram``-byte string inside it.
   Equal windows name equal strings at equal places, so a window whose string occurs once
   is not repeated. One pass gives the named strings with the windows they stand for.
2. Where two named strings with the same windows around them have equal bytes over all
   these windows (a 128-bit hash says so), all the windows are repeated: the inside of long
   repeats and copies is decided by counting.
3. What is left are named strings that recur in different surroundings, near the borders
   of repeats. The surroundings of one named string come together in a cell. There the
   Burrows-Wheeler transform of the concatenated surroundings is extended backwards,
   breadth first: intervals of common prefixes are enumerated by increasing length, each
   giving one border of the next common-prefix value, and the search stops at ``length``.
   Suffixes between which no border was met share ``length`` bytes.
4. A named string with more than ``MANY`` different surroundings is too much for one task;
   its windows are counted by their own 128-bit hashes, each a row, which splits evenly.

Null counts as empty. Texts below ``length`` bytes keep everything. Equal texts of at
least ``length`` bytes lose everything, as do repeated rows. Results depend on the text
only, so they are worked out once per different text.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.llm.common import Block, blocks, mix, powers, signed, slice_hash, text_key, text_of, BASE
from ordermart.session import freeze

LENGTH = 400
GRAM = 200
MANY = 1024
CELL_BYTES = 2 << 20

# Independent values of the bytes for the two halves of a 128-bit hash.
_FIRST, _SECOND = mix(np.arange(256, dtype=np.uint64), 17), mix(np.arange(256, dtype=np.uint64), 41)


def _sums(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(table[data] * powers(BASE, len(data)), out=sums[1:])
    return sums


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` consecutive values, by doubling."""
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def named_strings(block: Block, length: int, gram: int) -> dict[str, np.ndarray]:
    """Named strings of a block: place, and first and last window start they stand for."""
    n = len(block.data)
    if n < length:
        empty = np.zeros(0, dtype=np.int64)
        return {"row": empty, "place": empty, "low": empty, "high": empty}
    sums = _sums(block.data, _FIRST)
    start = np.arange(n - gram + 1)
    bits = np.uint64(max(20, n.bit_length()))
    value = slice_hash(sums, start, start + gram, 23)
    named = _sliding_least((value >> bits << bits) | start.astype(np.uint64), length - gram + 1)
    place = (named & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    row = np.repeat(np.arange(len(block)), np.diff(block.bounds))[: len(place)]
    inside = np.flatnonzero(np.arange(len(place)) + length <= block.bounds[row + 1])
    place, row = place[inside], row[inside]
    opens = np.ones(len(place), dtype=bool)
    opens[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(opens)
    last = np.append(first[1:], len(place)) - 1
    return {"row": row[first], "place": place[first], "low": inside[first], "high": inside[last] if len(first) else inside[:0]}


NAMED = "doc_id long, key binary, named long, left int, width int, hull long, hull2 long, start long"


def _count_names(length: int, gram: int):
    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                place = named_strings(block, length, gram)["place"]
                value = slice_hash(_sums(block.data, _FIRST), place, place + gram)
                yield pa.RecordBatch.from_arrays([pa.array(signed(value))], ["named"])

    return names


def _name(length: int, gram: int):
    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                found = named_strings(block, length, gram)
                place, low, high = found["place"], found["low"], found["high"]
                if not len(place):
                    continue
                one, two = _sums(block.data, _FIRST), _sums(block.data, _SECOND)
                rows = pa.array(found["row"] + block.first)
                yield pa.RecordBatch.from_arrays(
                    [
                        pc.take(batch.column("doc_id"), rows),
                        pc.take(batch.column("key"), rows),
                        pa.array(signed(slice_hash(one, place, place + gram))),
                        pa.array((place - low).astype(np.int32)),
                        pa.array((high - low).astype(np.int32)),
                        pa.array(signed(slice_hash(one, low, high + length, 1))),
                        pa.array(signed(slice_hash(two, low, high + length, 2))),
                        pa.array(low - block.bounds[found["row"]]),
                    ],
                    ["doc_id", "key", "named", "left", "width", "hull", "hull2", "start"],
                )

    return name


# --- the transform and its breadth-first search -----------------------------------------


def sorted_suffixes(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by at least their first ``depth`` symbols (values below 512)."""
    n, packed = len(symbols), 7
    padded = np.concatenate((symbols.astype(np.int64), np.zeros(packed, np.int64)))
    key = np.zeros(n, dtype=np.int64)
    for j in range(packed):
        key = (key << 9) | padded[j : j + n]
    # The rank of a suffix is the place where the suffixes that tie with it begin.
    rank = np.empty(n, dtype=np.int64)
    order = np.argsort(key)
    rank[order] = _places(key[order])
    del key, padded
    tied, known = np.arange(n), packed
    while known < depth:
        # Only suffixes that still tie are looked at again.
        tied = tied[np.bincount(rank, minlength=n)[rank[tied]] > 1]
        if not len(tied):
            break
        ahead = tied + known
        beyond = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        key = rank[tied] * (n + 1) + beyond
        order = np.argsort(key)
        tied, key = tied[order], key[order]
        # Ties stand together: a suffix moves by its place among those it tied with.
        lead = key // (n + 1)
        at = np.arange(len(key))
        begins = np.ones(len(key), dtype=bool)
        begins[1:] = lead[1:] != lead[:-1]
        rank[tied] = lead + _places(key) - np.maximum.accumulate(np.where(begins, at, 0))
        known *= 2
    return np.argsort(rank)


def _places(ordered: np.ndarray) -> np.ndarray:
    """For sorted values the place where each value begins."""
    begins = np.ones(len(ordered), dtype=bool)
    begins[1:] = ordered[1:] != ordered[:-1]
    return np.maximum.accumulate(np.where(begins, np.arange(len(ordered)), 0))


def prefix_borders(symbols: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Borders between neighbouring suffixes that share fewer than ``length`` symbols.

    Breadth-first backward extension on the Burrows-Wheeler transform: an interval of
    suffixes with a common prefix is extended by each symbol before it; where the border
    behind the new interval is still open, its common prefix has the length of this round.
    Symbol 0 separates texts: it may end a prefix but never stands inside one.
    """
    n = len(order)
    transform = symbols[order - 1]
    by_symbol = np.argsort(transform, kind="stable")
    target = np.empty(n, dtype=np.int64)
    target[by_symbol] = np.arange(n)
    same = transform[by_symbol[1:]] == transform[by_symbol[:-1]]
    following, preceding = np.full(n, n, dtype=np.int64), np.full(n, -1, dtype=np.int64)
    following[by_symbol[:-1][same]] = by_symbol[1:][same]
    preceding[by_symbol[1:][same]] = by_symbol[:-1][same]
    border = np.zeros(n + 1, dtype=bool)
    border[0] = border[n] = True
    # Round 0: one interval for each symbol.
    cuts = np.flatnonzero(np.diff(transform[by_symbol])) + 1
    low, high = np.concatenate(([0], cuts)), np.concatenate((cuts, [n]))
    border[high] = True
    for _ in range(1, length):
        size = high - low
        total = int(size.sum())
        if not total:
            break
        inside = np.arange(total) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low, size)
        keep = transform[inside] != 0
        first = keep & (preceding[inside] < np.repeat(low, size))
        last = keep & (following[inside] >= np.repeat(high, size))
        new_low, new_high = np.sort(target[inside[first]]), np.sort(target[inside[last]]) + 1
        open_ = ~border[new_high]
        low, high = new_low[open_], new_high[open_]
        border[high] = True
    return border


def repeated_starts(texts: list[bytes], times: np.ndarray, length: int) -> list[np.ndarray]:
    """Starts in each text of ``length`` bytes that start elsewhere too, in any of the texts.

    A text that stands for several occurrences (``times``) repeats all its strings.
    """
    sizes = np.array([len(t) + 1 for t in texts])
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    symbols = np.zeros(bounds[-1], dtype=np.int16)
    for text, at in zip(texts, bounds):
        symbols[at : at + len(text)] = np.frombuffer(text, np.uint8).astype(np.int16) + 1
    order = sorted_suffixes(symbols, length)
    border = prefix_borders(symbols, order, length)
    group = np.cumsum(border[:-1]) - 1
    owner = np.repeat(np.arange(len(texts)), sizes)
    inside = np.arange(len(symbols)) - bounds[owner]
    valid = inside + length < sizes[owner]
    weight = np.where(valid, np.minimum(times[owner], 2), 0)
    total = np.bincount(group, weights=weight[order])
    repeated = np.zeros(len(symbols), dtype=bool)
    repeated[order] = total[group] > 1
    repeated &= valid
    return [np.flatnonzero(repeated[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]


def runs(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of every run of consecutive numbers."""
    if not len(starts):
        return starts, starts
    cut = np.flatnonzero(np.diff(starts) > 1)
    return starts[np.concatenate(([0], cut + 1))], starts[np.append(cut, len(starts) - 1)]


# --- the job ----------------------------------------------------------------------------

MARKS = "key binary, start long, width int"


def _cell(length: int):
    def cell(table: pa.Table) -> pa.Table:
        keys, starts, widths = [], [], []
        texts = table.column("bytes").to_pylist()
        times = table.column("times").to_numpy()
        key, at = table.column("key").to_pylist(), table.column("start").to_numpy()
        for k, found in enumerate(repeated_starts(texts, times, length)):
            if times[k] == 1:
                for low, high in zip(*runs(found)):
                    keys.append(key[k])
                    starts.append(int(at[k] + low))
                    widths.append(int(high - low))
        return pa.table(
            {"key": pa.array(keys, pa.binary()), "start": pa.array(starts, pa.int64()), "width": pa.array(widths, pa.int32())}
        )

    return cell


def _contexts(length: int):
    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named, key, start, times, pieces = [], [], [], [], []
            wanted = batch.column("wanted").to_pylist()
            for row, text in enumerate(batch.column("text").cast(pa.large_binary())):
                data = text.as_buffer().to_pybytes()
                for w in wanted[row]:
                    named.append(w["named"])
                    key.append(batch.column("key")[row].as_py())
                    start.append(w["start"])
                    times.append(w["times"])
                    pieces.append(data[w["start"] : w["start"] + w["width"] + length])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(named, pa.int64()),
                    pa.array(key, pa.binary()),
                    pa.array(start, pa.int64()),
                    pa.array(times, pa.int64()),
                    pa.array(pieces, pa.binary()),
                ],
                ["named", "key", "start", "times", "bytes"],
            )

    return contexts


def _window_hashes(length: int):
    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("bytes"), 1 << 16):
                row = np.repeat(np.arange(len(block)), np.diff(block.bounds))
                low = np.flatnonzero(np.arange(len(row)) + length <= block.bounds[row + 1])
                row = row[low]
                one, two = _sums(block.data, _FIRST), _sums(block.data, _SECOND)
                rows = pa.array(row + block.first)
                start = pc.take(batch.column("start"), rows).to_numpy() + low - block.bounds[row]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(slice_hash(one, low, low + length, 1))),
                        pa.array(signed(slice_hash(two, low, low + length, 2))),
                        pc.take(batch.column("key"), rows),
                        pa.array(start),
                        pc.take(batch.column("times"), rows),
                    ],
                    ["hash", "hash2", "key", "start", "times"],
                )

    return hashes


def _remove(length: int):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, spans, digests, kept, texts, ranges = [], [], [], [], [], []
            marks = batch.column("marks").to_pylist()
            for row, text in enumerate(batch.column("text").cast(pa.large_binary())):
                data = np.frombuffer(text.as_buffer(), dtype=np.uint8)
                edge = np.zeros(len(data) + 1, dtype=np.int64)
                low = np.array([m["start"] for m in marks[row]])
                high = low + np.array([m["width"] for m in marks[row]]) + length
                np.add.at(edge, low, 1)
                np.add.at(edge, high, -1)
                gone = np.cumsum(edge[:-1]) > 0
                rest = data[~gone].tobytes()
                removed.append(int(gone.sum()))
                spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
                digests.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest)
                texts.append(rest.decode("utf-8", "replace"))
                step = np.diff(np.concatenate(([0], gone.view(np.int8), [0])))
                begin = np.flatnonzero(step == 1)
                width = np.flatnonzero(step == -1) - begin
                ranges.append([{"start": int(b), "length": int(w)} for b, w in zip(begin, width)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    pa.array(removed, pa.int64()),
                    pa.array(spans, pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array(kept, pa.binary()),
                    pa.array(texts, pa.string()),
                    pa.array(ranges, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
                ],
                ["key", "n_removed", "n_spans", "kept_sha256", "kept", "text", "removed"],
            )

    return remove


def cut_repeated_strings(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``key, n_removed, n_spans, kept_sha256, kept, text, removed`` of every text that loses bytes.

    ``key`` is the text's ``text_key``; ``kept`` are the bytes that stay, joined together,
    which need not be valid UTF-8: ``text`` is their text with U+FFFD for what is not.
    ``removed`` lists the maximal removed runs in bytes of the input.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"), text_of().alias("text"))
    named = source.mapInArrow(_name(length, gram), NAMED)
    names = source.select("text").mapInArrow(_count_names(length, gram), "named long")
    again = names.groupBy("named").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("named")
    # Stored, so that the join sees its size and can split a hot string.
    again = freeze(again, "recurring-names")
    candidates = freeze(named.join(again.hint("shuffle_hash"), "named"), "recurring-strings")

    surroundings = freeze(
        candidates.groupBy("named", "left", "width", "hull", "hull2").agg(
            F.count(F.lit(1)).alias("times"), F.min(F.struct("key", "start")).alias("first")
        ),
        "surroundings",
    )
    twice = surroundings.where("times > 1").select("named", "left", "width", "hull", "hull2")
    decided = candidates.join(twice, ["named", "left", "width", "hull", "hull2"]).select("key", "start", "width")

    # Named strings with an undecided surrounding and another one to compare it with.
    groups = surroundings.groupBy("named").agg(
        F.count(F.lit(1)).alias("kinds"), F.count_if(F.col("times") == 1).alias("open")
    )
    undecided = surroundings.join(groups.where("kinds > 1 AND open > 0").select("named", "kinds"), "named")

    owners = candidates.groupBy("key").agg(F.min("doc_id").alias("owner"))
    texts = freeze(
        source.join(owners.hint("shuffle_hash").withColumnRenamed("key", "owner_key"),
                    (F.col("key") == F.col("owner_key")) & F.col("doc_id").eqNullSafe(F.col("owner")))
        .select("key", "doc_id", "text")
        .dropDuplicates(["key", "doc_id"])
        .select("key", "text"),
        "texts-with-recurring-strings",
    )
    wanted = undecided.groupBy(F.col("first.key").alias("key")).agg(
        F.collect_list(F.struct("named", F.col("first.start").alias("start"), "width", "times")).alias("wanted")
    )
    contexts = texts.join(wanted, "key").mapInArrow(
        _contexts(length), "named long, key binary, start long, times long, bytes binary"
    )
    contexts = freeze(contexts.join(groups.select("named", "kinds"), "named"), "contexts")
    few, many = contexts.where(F.col("kinds") <= MANY), contexts.where(F.col("kinds") > MANY)

    total = few.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    cells = max(32, math.ceil(total / CELL_BYTES))
    compared = (
        few.select(F.pmod("named", F.lit(cells)).alias("cell"), "key", "start", "times", "bytes")
        # Repeats compress well, so partitions are not to be merged by their stored size.
        .repartition(cells, "cell")
        .groupBy("cell")
        .applyInArrow(_cell(length), MARKS)
    )
    windows = many.select("key", "start", "times", "bytes").mapInArrow(
        _window_hashes(length), "hash long, hash2 long, key binary, start long, times long"
    )
    shared = windows.groupBy("hash", "hash2").agg(F.sum("times").alias("n")).where("n > 1").select("hash", "hash2")
    counted = windows.where("times = 1").join(shared, ["hash", "hash2"]).select("key", "start", F.lit(0).alias("width"))

    marks = (
        decided.unionByName(compared)
        .unionByName(counted)
        .groupBy("key")
        .agg(F.collect_set(F.struct("start", "width")).alias("marks"))
    )
    return texts.join(marks, "key").mapInArrow(
        _remove(length),
        "key binary, n_removed long, n_spans long, kept_sha256 string, kept binary, text string, "
        "removed array<struct<start:long,length:long>>",
    )


def deduplicate_bytes(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, text, removed`` of every document.

    ``text`` is what stays of it and ``removed`` the runs that go, none for a text that stays.
    """
    text = text_of()
    rows = docs.select(
        "doc_id",
        text_key().alias("key"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.sha2(text, 256).alias("sha256"),
        text.alias("whole"),
    )
    cut = freeze(cut_repeated_strings(docs, length, gram).drop("kept"), "cut-texts")
    return rows.join(cut, "key", "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "sha256").alias("kept_sha256"),
        F.coalesce("text", "whole").alias("text"),
        F.coalesce("removed", F.array().cast("array<struct<start:long,length:long>>")).alias("removed"),
    )
