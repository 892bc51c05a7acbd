"""Substring deduplication by sliding sentence spans.

Sentences end at ``.``, ``!`` or ``?`` with white space after it, be there signs between, at
``。``, ``！``, ``？`` and at line breaks. Each letter of a script written without spaces
(kana, Chinese characters, full-width forms) counts as a word. A sentence of more than ``LONGEST`` words is cut where its own words say so: before
each word that begins the least hash of ``NEAR`` words among any ``GAP`` places in a row. So
no piece is longer than ``GAP`` words, and where a cut is depends on the ``GAP`` places
around it only, not on where the sentence begins. A span is a run of consecutive
sentences: from each sentence the shortest run of at least ``least`` sentences and
``least_words`` words, and to each sentence the shortest such run that ends there. Both
depend on nothing outside the run, so a passage yields the same spans wherever it stands:
one of ``4 * GAP + 16 + NEAR`` words, that is 50, inside a long sentence has at least one.

Spans meet in a global join on their hash (96 bits over the words, so case, white space and
signs, wide ones too, do not matter). All but the first occurrence, by ``doc_id`` and position, are
repeated, and a sentence that a repeated occurrence covers is removed.

Hashes are counted first; only spans whose hash occurs again carry their places through
the join. A null ``doc_id`` comes last in the order, ties go by a hash of the text. Of rows
equal in id and text one is the first and the others lose all their spans. Null and empty
texts, and texts of fewer sentences or words, have no spans and stay as they are. Shorter
repeats are found with lower ``least`` and ``least_words``, which may be 1: every sentence
that came before then goes, those that meet by chance too.

Very long texts are read whole. An empty table gives an empty result. Further columns keep
their names and values, whatever they are called.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermart.llm.common import Block, Words, blocks, column, mix, prefix_sums, signed, slice_hash, words
from ordermart.session import freeze
from ordermart.sinks.tables import plan_bytes

LEAST = 2
LEAST_WORDS = 20
LONGEST = 24
GAP, NEAR = 8, 2
LAST_ID = (1 << 63) - 1
# Bytes of the stored documents whose span hashes make one file, where a shuffle has more partitions.
FILE_BYTES = 8 << 20

_STOP = np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in ".!?"]] = True
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
# First bytes of three-byte letters that stand without spaces: U+3000 to U+9FFF, U+F000 to U+FFFF.
_WIDE = np.zeros(256, dtype=bool)
_WIDE[[*range(0xE3, 0xEA), 0xEF]] = True
# Wide signs that are no words, and those of them that end a sentence.
WIDE_SIGNS = "　、。，！？：；（）「」『』《》【】"
WIDE_STOPS = "。！？"


def _three_bytes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The letters of three bytes that begin at ``at``, as numbers."""
    wide = np.append(data, [0, 0, 0]).astype(np.int32)
    return (wide[at] << 16) + (wide[at + 1] << 8) + wide[at + 2]


def _numbers(letters: str) -> list[int]:
    return [int.from_bytes(c.encode(), "big") for c in letters]


def split_wide(found: Words, data: np.ndarray) -> tuple[Words, np.ndarray]:
    """Words with wide letters as words of their own and wide signs as none; places of wide stops."""
    lead = np.flatnonzero(_WIDE[data])
    if not len(lead):
        return found, lead
    start = np.unique(np.concatenate((found.start, lead, lead + 3)))
    host = np.searchsorted(found.start, start, side="right") - 1
    end = np.minimum(np.append(start[1:], len(data)), found.end[host])
    letter = _three_bytes(data, start)
    word = (start < end) & ~np.isin(letter, _numbers(WIDE_SIGNS))
    stops = start[(start < end) & np.isin(letter, _numbers(WIDE_STOPS))]
    row = found.row[host[word]]
    first = np.searchsorted(row, np.arange(len(found.first)))
    return Words(start[word], end[word], row, first, found.lowered), stops


def least_of_windows(value: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether each place holds the last least value of ``GAP`` places in a row of its run."""
    run = np.repeat(np.arange(len(first)), size)
    n = len(value)
    wide = np.ones(n, dtype=np.int64)
    for step in (-1, 1):
        holds = np.ones(n, dtype=bool)
        for apart in range(1, min(GAP, n)):
            here, there = (slice(apart, n), slice(0, n - apart)) if step < 0 else (slice(0, n - apart), slice(apart, n))
            larger = value[there] >= value[here] if step < 0 else value[there] > value[here]
            still = np.zeros(n, dtype=bool)
            still[here] = holds[here] & larger & (run[here] == run[there])
            holds = still
            wide += holds
    return wide >= GAP


class Sentences:
    """Sentences of a block: words ``[start, end)``, row, and byte where each begins."""

    def __init__(self, block: Block) -> None:
        data = block.data
        found, wide_stops = split_wide(words(block), data)
        n = len(found.start)
        opens = np.ones(n, dtype=bool)
        if n > 1:
            # Between two words: a line break, or a stop and later white space.
            passed = np.concatenate(([0], np.cumsum((data == 10) | (data == 13))))
            stops, spaces = np.flatnonzero(_STOP[data]), np.flatnonzero(_SPACE[data])
            low, high = found.end[:-1], found.start[1:]
            stop = np.append(stops, len(data))[np.searchsorted(stops, low)]
            space = np.insert(spaces, 0, -1)[np.searchsorted(spaces, high)]
            opens[1:] = (passed[high] > passed[low]) | (stop < space) | (found.row[1:] != found.row[:-1])
            opens[1:] |= np.searchsorted(wide_stops, high) > np.searchsorted(wide_stops, low)
        self.hashed = found.hashes()
        first = np.flatnonzero(opens)
        size = np.diff(np.append(first, n))
        long = size > LONGEST
        if long.any():
            chosen = np.repeat(long, size)
            sums, at, size = prefix_sums(self.hashed), np.flatnonzero(chosen), size[long]
            value = slice_hash(sums, at, np.minimum(at + NEAR, np.repeat(first[long] + size, size)))
            opens[at] |= least_of_windows(value, first[long], size)
        self.start = np.flatnonzero(opens)
        self.end = np.append(self.start[1:], n) if len(self.start) else self.start
        self.row = found.row[self.start]
        self.first = np.searchsorted(self.row, np.arange(len(block) + 1))
        self.byte = found.start[self.start]
        self.words = found

    def spans(self, least: int, least_words: int) -> tuple[np.ndarray, np.ndarray]:
        """First and last sentence of every span, sorted, each once."""
        n = len(self.start)
        number = np.arange(n)
        last = np.maximum(number + least - 1, np.searchsorted(self.end, self.start + least_words))
        fits = last < n
        fits[fits] &= self.row[number[fits]] == self.row[last[fits]]
        begin = np.minimum(
            number - least + 1, np.searchsorted(self.start, self.end - least_words, side="right") - 1
        )
        back = begin >= 0
        back[back] &= self.row[number[back]] == self.row[begin[back]]
        pairs = np.unique(
            np.concatenate((number[fits] * n + last[fits], begin[back] * n + number[back])).astype(np.int64)
        )
        return (pairs // n, pairs % n) if n else (pairs, pairs)


def _spans(least: int, least_words: int):
    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                found = Sentences(block)
                begin, last = found.spans(least, least_words)
                hashed = found.hashed
                start, end = found.start[begin], found.end[last]
                value = slice_hash(prefix_sums(hashed), start, end)
                check = slice_hash(prefix_sums(mix(hashed, 7)), start, end, 7)
                row = found.row[begin]
                rows = pa.array(row + block.first)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(value)),
                        pa.array((check >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                        pc.take(batch.column("id"), rows),
                        pc.take(batch.column("mark"), rows),
                        pa.array((begin - found.first[row]).astype(np.int32)),
                        pa.array((last - found.first[row]).astype(np.int32)),
                    ],
                    ["value", "check", "id", "mark", "begin", "last"],
                )

    return spans


SPANS = "value long, check int, id long, mark long, begin int, last int"


def repeated_spans(keyed: DataFrame, least: int, least_words: int) -> DataFrame:
    """``id, mark, begin, last`` of every span that is not the first of its kind."""
    source = keyed.select("id", "mark", "text")
    spans = source.mapInArrow(_spans(least, least_words), SPANS)
    again = spans.groupBy("value", "check").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    # Dealt by hash, so no task is larger than the others: small ones are merged before they are stored.
    files = math.ceil(min(plan_bytes(source) / FILE_BYTES, 1 << 20))
    files = max(keyed.sparkSession.sparkContext.defaultParallelism, files)
    again = freeze(again.coalesce(files), "repeated-hashes")
    places = freeze(spans.join(again.hint("shuffle_hash"), ["value", "check"]), "repeated-spans")
    place = F.struct("id", "mark", "begin", "last")
    # Stored, so that the join can split a span that very many documents share.
    first = places.groupBy("value", "check").agg(F.min(place).alias("first"))
    first = freeze(first.coalesce(files), "first-places")
    return places.join(first, ["value", "check"]).where(place != F.col("first")).select("id", "mark", "begin", "last")


def _cut(least: int, least_words: int, width: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text").cast(pa.large_binary())
            spans, copy = batch.column("spans"), batch.column("copy").to_numpy()
            touched = np.flatnonzero(pc.is_valid(spans).to_numpy(zero_copy_only=False) | (copy > 1))
            out: dict[int, bytes] = {}
            total, removed = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for block in blocks(batch.column("text")):
                found = Sentences(block)
                here = np.arange(block.first, block.first + len(block))
                total[here] = np.diff(found.first)
                chosen = here[np.isin(here, touched)]
                every = found.spans(least, least_words) if (copy[chosen] > 1).any() else None
                for row in chosen:
                    local = row - block.first
                    a, b = found.first[local], found.first[local + 1]
                    if copy[row] > 1:
                        own = found.row[every[0]] == local
                        begin, last = every[0][own] - a, every[1][own] - a
                    else:
                        pairs = np.array([(s["begin"], s["last"]) for s in spans[row].as_py()], dtype=np.int64)
                        begin, last = pairs[:, 0], pairs[:, 1]
                    edge = np.zeros(b - a + 1, dtype=np.int64)
                    np.add.at(edge, begin, 1)
                    np.add.at(edge, last + 1, -1)
                    gone = np.cumsum(edge)[:-1] > 0
                    removed[row] = gone.sum()
                    if not removed[row]:
                        continue
                    limits = np.append(found.byte[a:b], block.bounds[local + 1])
                    limits[0] = block.bounds[local]
                    data = block.data
                    out[int(row)] = b"".join(
                        data[limits[k] : limits[k + 1]].tobytes() for k in np.flatnonzero(~gone)
                    )
            if out:
                values = text.to_pylist()
                for row, value in out.items():
                    values[row] = value
                text = pa.array(values, pa.large_binary())
            columns = batch.columns[:width]
            yield pa.RecordBatch.from_arrays(
                [*columns, text.cast(pa.large_string()).cast(pa.string()), pa.array(total), pa.array(removed)],
                [f"c{k}" for k in range(width)] + ["text", "n_sentences", "n_removed"],
            )

    return cut


def cut_repeated_spans(
    docs: DataFrame, least: int = LEAST, least_words: int = LEAST_WORDS
) -> DataFrame:
    """``docs`` with ``text`` less its repeated spans, and ``_n_sentences, _n_removed``.

    Where ``docs`` has such a name, the count has more underscores before it.
    """
    n_sentences, n_removed = count_names(docs)
    identity = {
        "id": F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)),
        "mark": F.xxhash64("text"),
    }
    repeated = repeated_spans(docs.select("text", *[c.alias(k) for k, c in identity.items()]), least, least_words)
    # No more places than the document has sentences, twice.
    marked = repeated.groupBy("id", "mark").agg(F.collect_list(F.struct("begin", "last")).alias("spans"))
    names = docs.columns
    rest = [k for k, name in enumerate(names) if name.lower() != "text"]
    packed = docs.select(
        *[column(names[k]).alias(f"c{i}") for i, k in enumerate(rest)],
        F.col("text"),
        *[c.alias(k) for k, c in identity.items()],
    )
    joined = packed.hint("merge").join(marked, ["id", "mark"], "left")
    # The join has sorted the rows by these columns.
    joined = joined.withColumn("copy", F.row_number().over(Window.partitionBy("id", "mark").orderBy("id", "mark")))
    joined = joined.select(*[f"c{i}" for i in range(len(rest))], "text", "spans", "copy")
    types = dict(packed.dtypes)
    schema = ", ".join([f"c{i} {types[f'c{i}']}" for i in range(len(rest))])
    cut = joined.mapInArrow(
        _cut(least, least_words, len(rest)),
        f"{schema}{', ' if schema else ''}text string, n_sentences long, n_removed long",
    )
    back = {names[k]: F.col(f"c{i}") for i, k in enumerate(rest)}
    return cut.select(
        *[back.get(name, F.col("text")).alias(name) for name in names],
        F.col("n_sentences").alias(n_sentences),
        F.col("n_removed").alias(n_removed),
    )


def count_names(docs: DataFrame) -> list[str]:
    """Names of the two counts that ``docs`` does not have."""
    names, taken = ["_n_sentences", "_n_removed"], {c.lower() for c in docs.columns}
    while taken & set(names):
        names = [f"_{name}" for name in names]
    return names


def deduplicate_substrings(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without repeated spans; ``n_chars`` follows the text.

    A document of which no word is left is dropped; one that had no words before stays.
    """
    cut = cut_repeated_spans(docs, **options)
    n_sentences, n_removed = map(F.col, count_names(docs))
    kept = cut.where((n_removed == 0) | (n_removed < n_sentences))
    if "n_chars" in docs.columns:
        changed = F.when(n_removed > 0, F.char_length("text")).otherwise(F.col("n_chars"))
        kept = kept.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType))
    return kept.select(*[column(c) for c in docs.columns])
