"""The corpus pipeline over planted documents, against plain rules for each stage."""

import random

import corpus_pipeline
import pytest
from ordermart.llm.spans import LEAST, LEAST_WORDS

from .llm_cases import word_list
from .test_jaccard import brute as near_brute
from .test_spans import brute as span_brute

BAD = ["loser", "moronic", "wretched", "scumbag"]


@pytest.fixture(scope="module")
def planted():
    """Rows of documents, labels and benchmark, and what each id was planted as."""
    rng = random.Random(1)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrst"] + [f"w{k}" for k in range(900)]

    def prose(n):
        words = rng.choices(vocabulary, k=n)
        return " ".join(w + rng.choice([""] * 8 + [".", ".", "!"]) for w in words)

    docs, labels, kind = [], [], {}

    def add(text, what, toxic=None):
        i = len(docs)
        docs.append((i, text))
        kind[i] = what
        if toxic is not None:
            labels.append((i, 1, toxic))

    for k in range(300):
        add(prose(60), "clean", 0)
    for k in range(100):
        words = prose(60).split(" ")
        for bad in rng.sample(BAD, 3):
            words.insert(rng.randrange(60), bad)
        add(" ".join(words), "toxic", 1)
    items = [(k, prose(30)) for k in range(5)]
    for k in range(5):
        add(f"{prose(40)}. {items[k][1]} {prose(40)}", "leak")
    for k in range(10):
        base = prose(200).split(" ")
        add(" ".join(base), "kept copy")
        for _ in range(3):
            other = list(base)
            other[rng.randrange(200)] = "changed"
            add(" ".join(other), "near copy")
        add(" ".join(base), "exact copy")
    passage = prose(70) + "."
    for k in range(8):
        add(f"{prose(80)}.\n{passage}\n{prose(80)}.", "passage")
    docs += [(None, None), (9001, ""), (9002, "…")]
    return docs, labels, items, kind


@pytest.fixture(scope="module")
def folder(spark, planted, tmp_path_factory):
    docs, labels, items, _ = planted
    path = tmp_path_factory.mktemp("tables")
    rows = [(i, t, "en", "s", None if t is None else len(t), i) for i, t in docs]
    columns = "doc_id long, text string, lang string, source string, n_chars long, score long"
    spark.createDataFrame(rows, columns).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_stages_in_their_order(spark, planted, folder):
    docs, _, items, kind = planted
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity",
        "n-gram Jaccard join",
        "substring dedup",
        "benchmark decontamination",
        "best-fit packing",
    ]
    assert corpus_pipeline.ORACLE_SQL is None
    current = spark.read.parquet(f"{folder}/documents.parquet")
    columns = current.columns
    held = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        current = stage(spark, current, folder)
        assert current.columns == columns, name
        rows = [(r.doc_id, r.text) for r in current.collect()]
        held.append(rows)
        current = spark.createDataFrame(current.collect(), current.schema)
    ids = [{i for i, _ in rows} for rows in held]
    everything = {i for i, _ in docs}
    assert everything - ids[0] == {i for i, k in kind.items() if k == "toxic"}
    # One of each class stays, the one of the least id.
    classes = near_brute(held[0], 5, 0.8)
    assert ids[1] == {c for _, c, *_ in classes}
    # The null text and the empty one are copies, too.
    assert ids[0] - ids[1] == {i for i, k in kind.items() if k in ("near copy", "exact copy")} | {None}
    expected = span_brute(held[1], LEAST, LEAST_WORDS)
    assert sorted(((i, t or "") for i, t in held[2]), key=str) == sorted(
        ((i, t) for i, t, units, gone in expected if not units or gone < units), key=str
    )
    phrases = {tuple(w[k : k + 10]) for _, t in items for w in [word_list(t)] for k in range(len(w) - 9)}
    clean = {
        i
        for i, t in held[2]
        for w in [word_list(t)]
        if not any(tuple(w[k : k + 10]) in phrases for k in range(len(w) - 9))
    }
    assert ids[3] == clean and not any(kind.get(i) == "leak" for i in ids[3])
    assert {i for i, k in kind.items() if k in ("clean", "kept copy", "passage")} <= ids[3]


def test_run_packs_what_the_stages_keep(spark, planted, folder):
    got = corpus_pipeline.run(spark, folder).collect()
    _, _, _, kind = planted
    kept = {r.doc_id for r in got}
    assert {i for i, k in kind.items() if k in ("clean", "kept copy", "passage")} <= kept
    assert not any(kind.get(i) in ("toxic", "leak", "near copy", "exact copy") for i in kept)


def test_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").where("false").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
