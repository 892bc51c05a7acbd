"""Every filtering stage keeps columns of any name."""

import pytest
from ordermart.llm.contamination import drop_contaminated
from ordermart.llm.jaccard import drop_near_copies
from ordermart.llm.spans import deduplicate_substrings
from ordermart.llm.toxicity import drop_toxic

# Names the stages use or used inside.
NAMES = (
    "_kept_id _kept_key _text_key _matched_key kept_id kept_key matched_key row key id mark copy spans score positive "
    "weight held_out _n_sentences _n_removed __n_sentences n_sentences c0 c1 begin last item block terms node cluster value"
).split()
ROWS = [(1, "one two three four five six"), (2, "one two three four five six"), (3, "seven eight nine"), (None, None), (4, "")]


def stages(spark):
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(5)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, "seven eight nine")], "item_id long, text string")
    return {
        "toxicity": lambda docs: drop_toxic(docs, labels),
        "near copies": drop_near_copies,
        "substrings": deduplicate_substrings,
        "benchmark": lambda docs: drop_contaminated(docs, bench),
    }


@pytest.mark.parametrize("stage", ["toxicity", "near copies", "substrings", "benchmark"])
def test_clashing_names(spark, documents, stage):
    plain = documents(*ROWS, clashing=False)
    docs = plain.selectExpr("*", *[f"doc_id AS {name}" for name in NAMES], "text AS `a.b`", "text AS `words`")
    kept = stages(spark)[stage](docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert rows and all(r[name] == r.doc_id for r in rows for name in NAMES)
    expected = stages(spark)[stage](plain).select("doc_id", "text").collect()
    assert sorted(map(str, expected)) == sorted(str(type(r)(doc_id=r.doc_id, text=r.text)) for r in rows)
