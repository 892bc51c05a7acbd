import numpy as np
import pytest
from ordermart.llm.topk import exact_top_k, search_embeddings


def brute(vectors, queries, k):
    code = lambda v: [x is not None and x > 0 for x in v]
    out = []
    for q, v in queries:
        if not v:
            continue
        own = code(v)
        usable = [(i, code(c)) for i, c in vectors if c is not None and len(c) == len(v)]
        near = sorted((sum(a != b for a, b in zip(own, c)), i) for i, c in usable)[:k]
        out += [(q, rank + 1, i, d) for rank, (d, i) in enumerate(near)]
    return sorted(out)


@pytest.mark.parametrize("n,bits,k", [(300, 64, 10), (200, 13, 4), (6, 32, 10), (1, 8, 3)])
def test_against_brute_force(spark, n, bits, k):
    rng = np.random.default_rng(n)
    centres = rng.normal(size=(5, bits))
    rows = [(i, [float(x) for x in centres[i % 5] + rng.normal(size=bits)]) for i in range(n)]
    rows += [(1000 + i, rows[0][1]) for i in range(30 if n > 100 else 0)]
    rows += [(2000, None), (2001, []), (2002, [1.0] * (bits - 1)), (2003, [None] * bits)]
    df = spark.createDataFrame(rows, "id long, vector array<float>").selectExpr("*", "id AS code", "id AS query")
    got = exact_top_k(df, df.where("id % 7 = 0 OR id = 2003"), k).collect()
    queries = [r for r in rows if r[0] % 7 == 0 or r[0] == 2003]
    assert sorted(tuple(r) for r in got) == brute(rows, queries, k)


def test_empty_tables(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert search_embeddings(df).collect() == []
    one = spark.createDataFrame([(1, [1.0, -1.0], 0)], df.schema)
    assert search_embeddings(one).collect() == []
    assert [tuple(r) for r in search_embeddings(one, every=1).collect()] == [(1, 1, 1, 0)]


def test_one_vector_too_long_leaves_the_others(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=16)]) for i in range(60)] + [(70, [1.0] * 17)]
    df = spark.createDataFrame(rows, "id long, vector array<float>")
    got = exact_top_k(df, df.where("id % 7 = 0"), 5).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, [r for r in rows if r[0] % 7 == 0], 5)


def test_every_length_is_searched_among_its_own(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=(16, 3, 40)[i % 3])]) for i in range(90)]
    df = spark.createDataFrame(rows, "id long, vector array<float>")
    got = exact_top_k(df, df.where("id < 12"), 4).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, rows[:12], 4)
