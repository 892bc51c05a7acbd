"""Quality classifier: a linear hinge-loss model on n-gram indicators scaled by class ratios.

Indicators are of three kinds, hashed into ``BUCKETS``: byte n-grams; n-grams of word
shapes (case, whether the word repeats the one before, the signs behind it); and the share
of the words that have a shape, in powers of two. Each is scaled by the logarithm of its
smoothed class count ratio (naive Bayes), rows are brought to unit length, and dual
coordinate descent fits the support vectors. A logistic fit on rows the descent has not
seen turns margins into probabilities.

Only fitting uses a sample: at most ``PER_CLASS`` labelled rows of each class, outside the
held-out fold. Every whole text is scored in one narrow pass. Null and empty texts have no
indicators and get the score of the bias. Without labelled rows of both classes every
score is the prior. Repeated rows get equal scores.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ordermart.llm.common import Block, blocks, mix, prefix_sums, slice_hash, words
from ordermart.llm.samples import fold, labelled_sample
from ordermart.llm.toxicity import fit_logistic

BUCKETS = 1 << 17
PER_CLASS = 4_000
BYTE_GRAMS = (1, 2, 3)
SHAPE_GRAMS = (1, 2, 3)
THRESHOLD = 0.3


def _shapes(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Shape of every word of the block, and the first word of each row."""
    found = words(block)
    n = len(found.start)
    if not n:
        return np.zeros(0, np.uint64), found.first
    capital = np.concatenate(([0], np.cumsum(found.lowered != block.data)))
    capitals = capital[found.end] - capital[found.start]
    length = found.end - found.start
    starts_capital = found.lowered[found.start] != block.data[found.start]
    case = np.where(capitals == 0, 0, np.where((capitals == 1) & starts_capital, 1, np.where(2 * capitals >= length, 2, 3)))
    hashed = found.hashes()
    repeats = np.zeros(n, dtype=np.int64)
    repeats[1:] = (hashed[1:] == hashed[:-1]) & (found.row[1:] == found.row[:-1])
    following = np.minimum(
        np.append(found.start[1:], len(block.data)), np.minimum(block.bounds[found.row + 1], found.end + 4)
    )
    signs = slice_hash(prefix_sums(block.data), found.end, following, 3)
    return mix(signs + (case * 2 + repeats).astype(np.uint64), 5), found.first


def indicators(block: Block) -> Iterator[np.ndarray]:
    """Buckets of every row of the block, each once."""
    data = block.data.astype(np.uint64)
    mask = np.uint64(BUCKETS - 1)
    grams = []
    for n in BYTE_GRAMS:
        value = np.zeros(max(0, len(data) - n + 1), dtype=np.uint64)
        for j in range(n):
            value = value * np.uint64(257) + data[j : j + len(value)] + np.uint64(1)
        grams.append((mix(value, n) & mask).astype(np.int32))
    shapes, first = _shapes(block)
    seen = np.zeros(BUCKETS, dtype=np.int32)
    for row in range(len(block)):
        low, high = block.bounds[row], block.bounds[row + 1]
        parts = [g[low : max(low, high - n + 1)] for n, g in zip(BYTE_GRAMS, grams)]
        own = shapes[first[row] : first[row + 1]]
        for n in SHAPE_GRAMS:
            value = np.zeros(max(0, len(own) - n + 1), dtype=np.uint64)
            for j in range(n):
                value = mix(value ^ own[j : j + len(value)], n)
            parts.append((mix(value, 11) & mask).astype(np.int32))
        if len(own):
            kind, count = np.unique(own, return_counts=True)
            share = np.floor(np.log2(count / len(own))).astype(np.int64).clip(-6, 0)
            parts.append((mix(kind ^ (share + 99).astype(np.uint64), 13) & mask).astype(np.int32))
        found = np.concatenate(parts)
        place = np.arange(len(found), dtype=np.int32)
        seen[found] = place
        yield found[seen[found] == place]


@dataclass
class Model:
    weights: np.ndarray  # descent weight times ratio, by bucket
    ratios: np.ndarray
    scale: float
    bias: float

    def margin(self, found: np.ndarray) -> float:
        length = math.sqrt(float(np.square(self.ratios[found]).sum()))
        return float(self.weights[found].sum()) / length if length else 0.0


def class_ratios(rows: list[np.ndarray], positive: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    """Log ratio of the smoothed, normalized indicator counts of the two classes."""
    counts = []
    for value in (1, 0):
        own = [r for r, p in zip(rows, positive) if p == value]
        count = smoothing + np.bincount(np.concatenate(own) if own else np.zeros(0, np.int64), minlength=BUCKETS)
        counts.append(count / (len(own) + smoothing))
    return np.log(counts[0] / counts[1])


def dual_descent(
    rows: list[np.ndarray], y: np.ndarray, cost: np.ndarray, ratios: np.ndarray, epochs: int = 20
) -> np.ndarray:
    """L1-loss support vector machine by dual coordinate descent; rows have unit length."""
    weights = np.zeros(BUCKETS)
    alpha = np.zeros(len(rows))
    values = []
    for found in rows:
        value = ratios[found]
        length = np.sqrt(np.square(value).sum())
        values.append(value / length if length else value)
    random = np.random.default_rng(0)
    for _ in range(epochs):
        most = 0.0
        for k in random.permutation(len(rows)):
            found, value = rows[k], values[k]
            if not len(found):
                continue
            gradient = y[k] * (weights[found] @ value) - 1
            new = min(max(alpha[k] - gradient, 0.0), cost[k])
            step = new - alpha[k]
            if step:
                weights[found] += step * y[k] * value
                alpha[k] = new
                most = max(most, abs(step))
        if most < 1e-3:
            break
    return weights


def fit(rows: list[np.ndarray], positive: np.ndarray, weight: np.ndarray, check: np.ndarray, cost: float = 1.0) -> Model:
    """Descent on the rows not in ``check``, probabilities on those in it."""
    if not (positive == 1).any() or not (positive == 0).any():
        prior = ((positive == 1).sum() + 1) / (len(positive) + 2)
        return Model(np.zeros(BUCKETS), np.zeros(BUCKETS), 0.0, math.log(prior / (1 - prior)))
    learn = np.flatnonzero(~check)
    ratios = class_ratios([rows[k] for k in learn], positive[learn])
    # Both classes weigh as much in all.
    share = (positive[learn] == 1).mean()
    costs = cost * np.where(positive[learn] == 1, 0.5 / share, 0.5 / (1 - share))
    weights = dual_descent([rows[k] for k in learn], 2.0 * positive[learn] - 1, costs, ratios)
    model = Model(weights * ratios, ratios, 1.0, 0.0)
    judged = np.flatnonzero(check) if len(set(positive[check])) == 2 else np.arange(len(rows))
    margins = np.array([[model.margin(rows[k])] for k in judged])
    slope, model.bias = fit_logistic(margins, positive[judged].astype(float), weight[judged], penalty=0.1)
    model.scale = float(slope[0])
    return model


def _sample_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [r for block in blocks(batch.column("text")) for r in indicators(block)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(found, pa.list_(pa.int32())), batch.column("positive"), batch.column("weight"), batch.column("check")],
            ["found", "positive", "weight", "check"],
        )


def learn(
    docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, held_out: int = 0, per_class: int = PER_CLASS
) -> Model:
    sample = labelled_sample(docs, labels, label, fold(folds) != held_out, per_class)
    # A fifth of the sample is for the probabilities.
    checked = sample.select("text", "positive", "weight", (F.pmod(F.xxhash64("text"), F.lit(5)) == 0).alias("check"))
    table = checked.mapInArrow(
        _sample_rows, "found array<int>, positive int, weight double, check boolean"
    ).toPandas()
    rows = [np.asarray(r, dtype=np.int32) for r in table["found"]]
    return fit(rows, table["positive"].to_numpy(), table["weight"].to_numpy(), table["check"].to_numpy(bool))


def quality_score(model: Model, text: Column) -> Column:
    """Probability that a text is of good quality, by its whole text."""
    small = Model(model.weights.astype(np.float32), model.ratios.astype(np.float32), model.scale, model.bias)

    @arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        margins = np.array([small.margin(r) for block in blocks(column) for r in indicators(block)])
        return pa.array(1 / (1 + np.exp(-np.clip(margins * small.scale + small.bias, -30, 30))))

    return score(text)


def judge_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    model = learn(docs, labels)
    scored = docs.select("doc_id", quality_score(model, F.col("text")).alias("score"))
    return scored.select(
        "doc_id",
        (fold(5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
