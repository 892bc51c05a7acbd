import random
import zlib

import numpy as np
import pyarrow as pa
from ordermart.llm import quality as q
from ordermart.llm.common import blocks

from .llm_cases import ODD


def found(*texts):
    return [set(r.tolist()) for b in blocks(pa.array(texts)) for r in q.indicators(b)]


def test_indicators_are_of_the_text_alone_and_each_once():
    texts = ["Some Text here.", "", "SOME!! TEXT!!", "a a a a", "é | b | c"]
    together = [r for b in blocks(pa.array(texts)) for r in q.indicators(b)]
    assert all(len(set(r.tolist())) == len(r) for r in together)
    assert found(*texts) == [found(t)[0] for t in texts]
    assert found("")[0] == set() and len({frozenset(f) for f in found(*texts)}) == 5


def test_descent_finds_the_margin():
    rng = np.random.default_rng(1)
    rows, y = [], []
    for k in range(200):
        own = rng.choice(np.arange(10, 400), 20, replace=False)
        rows.append(np.append(own, k % 2).astype(np.int32))
        y.append(k % 2)
    y = np.array(y)
    ratios = q.class_ratios(rows, y)
    assert ratios[1] > 0 > ratios[0]
    model = q.fit(rows, y, np.ones(200), np.arange(200) % 5 == 0)
    p = [1 / (1 + np.exp(-(model.margin(r) * model.scale + model.bias))) for r in rows]
    assert ((np.array(p) > 0.5) == (y == 1)).mean() > 0.97


def labelled_rows():
    rng = np.random.default_rng(4)
    y = np.arange(60) % 3 > 0
    # Classes overlap, so the costs bind for some rows; one row has no indicators.
    rows = [rng.choice(np.arange(30 * k, 30 * k + 45), 12, replace=False).astype(np.int32) for k in y]
    rows[7] = np.zeros(0, np.int32)
    return rows, y.astype(int)


def test_ratios_by_plain_counting():
    rows, y = labelled_rows()
    got = q.class_ratios(rows, y)
    for bucket in (0, 29, 31, 44, 74, 5000):
        share = []
        for value in (1, 0):
            own = [r for r, label in zip(rows, y) if label == value]
            share.append((1 + sum(bucket in r.tolist() for r in own)) / (len(own) + 1))
        assert np.isclose(got[bucket], np.log(share[0] / share[1]))


def test_descent_agrees_with_a_plain_solver():
    """Projected gradient on the dense dual problem, run until it stands still."""
    rows, labels = labelled_rows()
    y, cost = 2.0 * labels - 1, np.where(labels == 1, 0.75, 1.5)
    ratios = q.class_ratios(rows, labels)
    dense = np.zeros((len(rows), 80))
    for k, found in enumerate(rows):
        dense[k, found] = ratios[found]
        dense[k] /= np.linalg.norm(dense[k]) or 1
    signed = dense * y[:, None]
    kernel = signed @ signed.T
    alpha, step = np.zeros(len(rows)), 1 / np.linalg.norm(kernel, 2)
    for _ in range(50_000):
        alpha = np.clip(alpha - step * (kernel @ alpha - 1), 0, cost)
    expected = signed.T @ alpha

    def objective(weights):
        return 0.5 * weights @ weights + cost @ np.maximum(0, 1 - signed @ weights)

    got = q.dual_descent(rows, y, cost, ratios, epochs=2_000)
    assert not got[80:].any()
    assert np.allclose(got[:80], expected, atol=0.02)
    assert abs(objective(got[:80]) - objective(expected)) < 1e-3 * objective(expected)
    # What the query runs is as good to within a hundredth.
    assert objective(q.dual_descent(rows, y, cost, ratios)[:80]) < 1.01 * objective(expected)


def test_scores_of_held_out_rows(spark, documents):
    random.seed(3)
    rows, marks = [], []
    for i in range(300):
        words = [f"w{random.randrange(500)}" for _ in range(30)]
        good = i % 3 > 0
        rows.append((i, " ".join(words) + "." if good else " ".join(w.upper() + "!!" for w in words)))
        marks.append((i, int(good), 0))
    labels = spark.createDataFrame(marks + [(None, 1, 0), (7000, None, 0)], "doc_id long, quality int, toxic int")
    got = q.judge_quality(documents(*rows, *ODD), labels).collect()
    assert len(got) == 300 + len(ODD)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id >= 10 and r.doc_id < 300]
    assert held and np.mean([r.predicted == int(r.doc_id % 3 > 0) for r in held]) > 0.95
    prior = q.judge_quality(documents(*rows), labels.where("quality = 1")).collect()
    assert len({r.score for r in prior}) == 1
    assert q.judge_quality(documents(*rows).where("false"), labels).collect() == []


def test_held_out_accuracy_on_the_given_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scored = q.judge_quality(docs, labels).join(labels, "doc_id").where("held_out AND quality IS NOT NULL").collect()
    assert np.mean([r.predicted == r.quality for r in scored]) > 0.95
