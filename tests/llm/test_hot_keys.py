"""A key that most rows share is split over tasks where it meets one row of an aggregate."""

import pytest
from ordermart.llm.components import _large_star, connected_components
from ordermart.llm.spans import repeated_spans
from ordermart.session import freeze
from pyspark.sql import functions as F

SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.files.maxPartitionBytes": "16k",
    "spark.sql.files.openCostInBytes": "1k",
    # Small row groups, so that a small file is read by several tasks.
    "parquet.block.size": "4096",
}


@pytest.fixture
def skew(spark):
    before = {key: spark.conf.get(key, None) for key in SKEW}
    for key, value in SKEW.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def executed(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def test_a_hub(spark, skew, tmp_path):
    spark.range(1, 30_000, 1, 8).select(F.col("id").alias("a"), F.lit(0).cast("long").alias("b")).write.parquet(str(tmp_path / "e"))
    edges = spark.read.parquet(str(tmp_path / "e"))
    rows, plan = executed(_large_star(edges))
    assert len(rows) == 29_999 and "SortMergeJoin(skew=true)" in plan
    assert connected_components(edges).agg(F.count_distinct("node"), F.count_distinct("root")).first()[0:2] == (30_000, 1)


def test_a_span_of_very_many_documents(spark, skew):
    shared = "This sentence has quite a few words in it to begin with. And this other one adds ten words more to them."
    docs = spark.range(0, 6_000, 1, 8).select(
        "id", F.xxhash64("id").alias("mark"), F.concat(F.lit(shared + " Number "), "id", F.lit(" ends here.")).alias("text")
    )
    rows, plan = executed(repeated_spans(docs, 2, 20))
    assert len({r.id for r in rows}) == 5_999 and "SortMergeJoin(skew=true)" in plan


def test_edges_to_a_hub_need_no_round(spark, monkeypatch):
    monkeypatch.setattr("ordermart.llm.components._large_star", lambda *edges: pytest.fail("a round was made"))
    edges = spark.range(1, 100).selectExpr("id AS a", "id % 3 - 3 AS b")
    assert dict(connected_components(edges).collect()) == {n: n % 3 - 3 if n > 0 else n for n in [-3, -2, -1, *range(1, 100)]}


def test_a_chain_is_joined_in_few_rounds(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr("ordermart.llm.components._large_star", lambda *edges: rounds.append(1) or _large_star(*edges))
    edges = spark.range(1, 40).selectExpr("id AS a", "id - 1 AS b")
    assert dict(connected_components(edges).collect()) == dict.fromkeys(range(40), 0)
    assert len(rounds) < 10


def test_span_hashes_of_little_text_are_stored_in_few_files(spark, monkeypatch, tmp_path):
    stored = {}
    monkeypatch.setattr("ordermart.llm.spans.freeze", lambda df, name: stored.setdefault(name, freeze(df, name)))
    texts = [(n, n, f"The passage number {n // 2} has words enough to be a span. " * 2 + f"It is number {n}.") for n in range(400)]
    spark.createDataFrame(texts, "id long, mark long, text string").write.parquet(str(tmp_path / "d"))
    before = {key: spark.conf.get(key) for key in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = repeated_spans(spark.read.parquet(str(tmp_path / "d")), 2, 20)
        assert found.select("id").distinct().count() == 200
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    most = max(spark.sparkContext.defaultParallelism, 2)
    assert all(len(stored[name].inputFiles()) <= most for name in ("repeated-hashes", "first-places"))
