import math

import numpy as np
import pytest
from ordermart.llm import negatives
from ordermart.llm.negatives import (
    Best,
    inner_products,
    mine_embeddings,
    mine_negatives,
    pack_planes,
    subset_sums,
    unpack_planes,
)

SCHEMA = "id long, label int, vector array<double>, score long, rank int"
NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, every=100, positives=5, wanted=10):
    kept = []
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((i, label, tuple(math.floor(256 * x) for x in v)))
    out = []
    for a, label, v in {r for r in kept if r[0] % every == 0}:
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, m) for i, m, w in kept if len(w) == len(v))
        near = [(-s, i) for s, i, m in scored if m == label and i != a][:positives]
        for p, i in near:
            chosen = [(-s, j) for s, j, m in scored if m != label and 30 * p <= -100 * s <= 90 * p][:wanted]
            out += [(a, i, rank + 1, j, p, s) for rank, (s, j) in enumerate(chosen)]
    return sorted(out)


def mine(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA).repartition(3)
    found = mine_negatives(df, **options)
    assert found.columns == NAMES
    return sorted(map(tuple, found.collect()))


def clustered(n, dimensions, seed, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, dimensions)) + 0.8
    return [(i, i % labels, [float(x) for x in centres[(i * 7) % labels] + rng.normal(size=dimensions)]) for i in range(n)]


@pytest.mark.parametrize("dimensions,block", [(64, 50_000), (13, 2), (1, 50_000)])
def test_against_brute_force(spark, dimensions, block):
    rows = clustered(500, dimensions, dimensions)
    rows += [(1000 + i, 0, rows[0][2]) for i in range(40)] + [(1000, 0, rows[0][2]), (1000, 1, rows[3][2])]
    assert mine(spark, rows, block=block) == brute(rows)


def test_rows_that_take_no_part(spark):
    rows = clustered(220, 8, 3)
    odd = [
        (None, 1, [1.0] * 8),
        (300, None, [1.0] * 8),
        (400, 1, None),
        (500, 1, [1.0] * 7 + [None]),
        (600, 1, [1.0] * 7 + [math.inf]),
        (700, 1, [math.nan] * 8),
        (800, 1, [1e300] + [1.0] * 7),
    ]
    assert mine(spark, rows + odd) == brute(rows)
    assert mine(spark, odd) == []


def test_every_length_is_searched_among_its_own(spark):
    rows = clustered(300, 8, 4) + [(1000 + i, l, v) for i, l, v in clustered(250, 11, 5)] + [(2000, 1, []), (2001, 1, []), (2002, 2, [])]
    assert mine(spark, rows) == brute(rows)


def test_one_hot_vector_and_label(spark):
    """A third of the rows are one vector, and another third has one label."""
    rows = clustered(300, 16, 6)
    rows += [(1000 + i, i % 2, rows[1][2]) for i in range(300)] + [(2000 + i, 3, r[2]) for i, r in enumerate(rows)]
    assert mine(spark, rows) == brute(rows)


def test_empty_table_and_moved_labels(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert mine_embeddings(empty).collect() == []
    rows = [(i, l, [float(np.float32(x)) for x in v]) for i, l, v in clustered(210, 8, 7, labels=10)]
    df = spark.createDataFrame([(i, v, l) for i, l, v in rows], "vec_id long, embedding array<float>, label int")
    moved = [(i, (l + 1) % 10 if i % 7 == 0 else l, v) for i, l, v in rows]
    assert sorted(map(tuple, mine_embeddings(df).collect())) == brute(moved) != brute(rows)


@pytest.mark.parametrize("top", [1, 130, 1 << 20])
def test_lookups_are_inner_products(top):
    rng = np.random.default_rng(top)
    a, c = rng.integers(-top, top, (20, 24)), rng.integers(-top, top, (50, 24))
    c[0], c[1] = -top, top - 1
    packed = pack_planes(c, int(top - 1).bit_length() + 1)
    assert (unpack_planes(packed) == c).all()
    assert (inner_products(subset_sums(a), packed) == c @ a.T).all()


def test_best_rows_with_ties():
    rng = np.random.default_rng(1)
    best, met = Best(3, 4), []
    for _ in range(6):
        ids, scores = rng.permutation(1000)[:50], rng.integers(0, 5, (50, 2))
        scores[rng.random((50, 2)) < 0.2] = negatives.NONE
        best.offer(1, ids, scores)
        met += [(o + 1, -s, i) for i, row in zip(ids, scores) for o, s in enumerate(row) if s != negatives.NONE]
    rows = [tuple(r.values()) for r in best.rows().to_pylist()]
    expected = [(o, i, -s) for owner in (1, 2) for o, s, i in sorted(m for m in met if m[0] == owner)[:4]]
    assert rows == expected
