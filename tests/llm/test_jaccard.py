import random

import numpy as np
import pyarrow as pa
import pytest
from .llm_cases import ODD, word_list
from ordermart.llm import jaccard as j
from ordermart.llm.components import connected_components


def grams(text, n):
    words = word_list(text)
    return frozenset(tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))) if words else frozenset()


def brute(rows, n, threshold):
    """Class (as least id), number of linked different texts, and rows of equal words."""
    texts = [t or "" for _, t in rows]
    sets = [grams(t, n) for t in texts]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    links = [set() for _ in rows]
    for a in range(len(rows)):
        for b in range(a):
            same = texts[a] == texts[b]
            if same or (sets[a] and sets[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])):
                low, high = sorted((find(a), find(b)))
                root[high] = low
                if not same:
                    links[a].add(texts[b])
                    links[b].add(texts[a])
    words = [tuple(word_list(t)) or t for t in texts]
    classes = {}
    for k, (i, _) in enumerate(rows):
        classes.setdefault(find(k), []).append(i)
    least = {k: min((i for i in v if i is not None), default=None) for k, v in classes.items()}
    return sorted(
        ((i, least[find(k)], len(links[k]), words.count(words[k])) for k, (i, _) in enumerate(rows)), key=str
    )


def near_rows(seed, n_groups=12, size=6):
    random.seed(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = []
    for _ in range(n_groups):
        base = random.choices(vocabulary, k=random.randint(1, 60))
        for _ in range(random.randint(1, size)):
            words = list(base)
            for _ in range(random.randint(0, 3)):
                words[random.randrange(len(words))] = random.choice(vocabulary)
            rows.append((len(rows) + 10, random.choice([" ", ", "]).join(words)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(documents, seed):
    rows = near_rows(seed) + ODD
    got = j.near_duplicate_classes(documents(*rows), recall=0.9999).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 5, 0.8)


def test_large_clusters_are_cut_into_chunks(documents, monkeypatch):
    monkeypatch.setattr(j, "CHUNK", 4)
    random.seed(4)
    base = [f"b{k}" for k in range(200)]
    rows = []
    for k in range(40):
        words = list(base)
        words[random.randrange(200)] = f"x{k}"
        words[random.randrange(200)] = f"y{k}"
        rows.append((k, " ".join(words)))
    rows += near_rows(5)
    rows = [(n, t) for n, (_, t) in enumerate(rows)]
    got = j.near_duplicate_classes(documents(*rows), recall=0.9999).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 5, 0.8)


def test_bands_reach_the_recall():
    bands, rows = j.bands_and_rows(0.8, 0.999, 160)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.999 and bands * rows <= 160
    with pytest.raises(ValueError):
        j.bands_and_rows(0.1, 0.999999, 4)


def test_signatures_estimate_the_similarity():
    rng = np.random.default_rng(1)
    shared, a, b = (rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (600, 200, 200))
    flat = np.concatenate((shared, a, shared, b))
    got = j.signatures(flat, np.array([0, 800, 1600]), 400)
    assert abs((got[0] == got[1]).mean() - 0.6) < 0.1


def test_components(spark):
    edges = [(k, k + 1) for k in range(30)] + [(100, k) for k in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {k: 0 for k in range(31)} | {k: 100 for k in range(100, 140)} | {200: 200, 201: 200}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_one_row_of_every_class_stays(documents):
    # Class ids are ids of documents, so they tell classes apart only where these do.
    rows = near_rows(6) + [(9, "same row"), (9, "same row")] + [r for r in ODD if r[0] != 5]
    docs = documents(*rows)
    kept = j.drop_near_copies(docs)
    assert kept.columns == docs.columns
    found = kept.collect()
    classes = {(r.doc_id, r.class_id) for r in j.near_duplicate_classes(docs).collect()}
    assert len(found) == len({c for _, c in classes if c is not None}) + 1  # and the class without an id
    assert sum(r.text == "same row" for r in found) == 1
    assert j.drop_near_copies(docs.where("false")).collect() == []


@pytest.mark.parametrize("side,pair,links", [([0, 0], (0, 1), 0), ([1, 1], (0, 1), 0), ([0, 1], (0, 1), 1), ([0, 0], (1, 1), 1)])
def test_an_empty_chunk_adds_no_links(side, pair, links):
    words = [f"w{k}" for k in range(100)]
    table = pa.table(
        {
            "cell": [7, 7],
            "i": [pair[0]] * 2,
            "j": [pair[1]] * 2,
            "side": side,
            "node": [1, 2],
            "cluster": [7, 7],
            "n_texts": [1, 1],
            "text": [" ".join(words), " ".join(words[:-1])],
        }
    )
    got = j._verify(5, 0.8)(table).to_pydict()
    assert got["links"] == [links] * 2 and got["root"] == ([1, 1] if links else [1, 2])
