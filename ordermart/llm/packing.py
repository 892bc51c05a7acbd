"""Best-fit packing of documents into sequences of several permitted lengths.

A document is its words and one closing token; one longer than the longest sequence is
cut into pieces. Pieces are dealt evenly into cells of a bounded number of pieces, and a
cell packs its pieces, longest first:

* a piece goes to the open bin with the least room that still holds it;
* without such a bin one is opened. Each permitted length that holds the piece is filled on
  trial from the pieces still to be packed, always with the longest that fits; the length
  whose trial contents, in the least length that holds them, cost least for each token is
  opened, the shorter one on a tie;
* in the end every bin shrinks to the least permitted length that holds its contents.

So the lengths are chosen together, by what is left for them: a long bin is opened for a
piece that needs it or where its contents repay it, not because it might once be full. The
cost of a bin is that of training on it: a part for each token, one for each pair of tokens
and one for the sequence. With a cost that grows no faster than the length the longest bin
would always win.

Empty and null texts are one closing token. Repeated rows are packed as often as they
occur. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import LongType

from ordermart.llm.common import blocks, text_of, words
from ordermart.session import checkpoint

LENGTHS = (512, 1024, 2048, 4096, 8192)
# Cost of a bin besides its tokens, in tokens; length at which pairs cost as much as tokens.
BIN_COST = 64
PAIRS_EQUAL = 24_576
CELL_PIECES = 20_000
LEAST_CELLS = 32


@arrow_udf(LongType())
def count_words(column: pa.Array) -> pa.Array:
    return pa.array(np.concatenate([np.diff(words(b).first) for b in blocks(column)] or [np.zeros(0, np.int64)]))


def bin_cost(length: int) -> float:
    return length + length * length / PAIRS_EQUAL + BIN_COST


class Left:
    """Pieces still to be packed, by size: bit s of ``sizes`` says that some have size s."""

    def __init__(self, pieces: np.ndarray, longest: int) -> None:
        self.count = np.bincount(pieces, minlength=longest + 1).tolist()
        self.sizes = sum(1 << size for size, n in enumerate(self.count) if n)

    def take(self, size: int) -> None:
        self.count[size] -= 1
        if not self.count[size]:
            self.sizes ^= 1 << size

    def fill(self, room: int) -> int:
        """Tokens that go into ``room``, always the longest piece that fits."""
        filled, sizes = 0, self.sizes
        while room:
            sizes &= (1 << (room + 1)) - 1
            if not sizes:
                break
            size = sizes.bit_length() - 1
            taken = size * min(self.count[size], room // size)
            filled += taken
            room -= taken
            sizes ^= 1 << size
        return filled


def best_fit(
    sizes: Sequence[int], lengths: Sequence[int] = LENGTHS, cost: Callable[[int], float] = bin_cost
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of every piece; length and contents of every bin."""
    lengths = sorted(lengths)
    sizes = np.asarray(sizes, dtype=np.int64)
    where, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    opened: list[int] = []
    used: list[int] = []
    # Bit r of ``rooms`` says that some bin has room r; ``by_room[r]`` are those bins.
    rooms, by_room = 0, [[] for _ in range(lengths[-1] + 1)]
    left = Left(sizes, lengths[-1])
    costs = [cost(length) for length in lengths]

    def price(size: int, length: int) -> tuple[float, int]:
        contents = size + left.fill(length - size)
        return costs[bisect_left(lengths, contents)] / contents, length

    for piece in np.argsort(-sizes, kind="stable"):
        size = int(sizes[piece])
        left.take(size)
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            number = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room = min(price(size, length) for length in lengths if length >= size)[1]
            number = len(opened)
            opened.append(room)
            used.append(0)
        where[piece], offset[piece] = number, used[number]
        used[number] += size
        room -= size
        if room:
            by_room[room].append(number)
            rooms |= 1 << room
    filled = np.asarray(used, dtype=np.int64)
    final = np.asarray(lengths, dtype=np.int64)[np.searchsorted(lengths, filled)] if len(filled) else filled
    return where, offset, final, filled


def _pack(lengths: Sequence[int]):
    def pack(cell: pd.DataFrame) -> pd.DataFrame:
        cell = cell.sort_values(["number", "piece"], ignore_index=True)
        where, offset, final, filled = best_fit(cell["n_tokens"].to_numpy(), lengths)
        return pd.DataFrame(
            {
                "doc_id": cell["doc_id"],
                "piece": cell["piece"],
                "token_start": cell["token_start"],
                "n_tokens": cell["n_tokens"],
                "bin_id": (cell["cell"].to_numpy(np.int64) << 32) + where,
                "bin_offset": offset,
                "bin_length": final[where],
                "bin_used": filled[where],
            }
        )

    return pack


PLACED = (
    "doc_id long, piece int, token_start long, n_tokens long, bin_id long, bin_offset long, "
    "bin_length long, bin_used long"
)


def pack_documents(docs: DataFrame, lengths: Sequence[int] = LENGTHS) -> DataFrame:
    """One row per piece: where it starts in its document, its bin, and its place there."""
    longest = max(lengths)
    tokens = count_words(text_of()) + 1
    # Stored with its row order: the number of a row is the same on any retry.
    counted = checkpoint(docs.select("doc_id", tokens.alias("tokens")))
    numbered = counted.withColumn("number", F.monotonically_increasing_id())
    pieces = numbered.select(
        "doc_id",
        "tokens",
        "number",
        F.explode(F.sequence(F.lit(0), F.ceil(F.col("tokens") / longest).cast("int") - 1)).alias("piece"),
    )
    n = counted.agg(F.sum(F.ceil(F.col("tokens") / longest))).first()[0] or 0
    cells = max(LEAST_CELLS, math.ceil(n / CELL_PIECES))
    start = F.col("piece").cast("long") * longest
    return (
        pieces.select(
            "doc_id",
            "piece",
            start.alias("token_start"),
            F.least(F.lit(longest), F.col("tokens") - start).cast("long").alias("n_tokens"),
            F.pmod(F.xxhash64("number", "piece"), F.lit(cells)).cast("int").alias("cell"),
            "number",
        )
        .groupBy("cell")
        .applyInPandas(_pack(lengths), PLACED)
    )
