"""Registered queries against their SQL, and known numbers of the derived raw orders."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from gate.compare import differences
from gate.inputs import raw_orders
from gate.oracle import ORACLE
from gate.spark_queries import AT, QUERIES, dq_report
from ordermart.operators.staging import stage_latest, stage_runs

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_its_sql(spark, name):
    assert differences(spark, SMALL, name) == ""


def test_every_query_has_sql_and_reads_whole_tables():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())
    for name, sql in contract.oracle_sql().items():
        assert not re.search(r"\b(LIMIT|SAMPLE)\b", sql, re.IGNORECASE), name


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["region", "category", "status", "order_count", "total_quantity", "total_revenue"]
    assert df.count() > 0


def test_known_numbers(spark):
    raw = raw_orders(spark, MIDDLE).cache()
    counts = {r.check_name: r.rows_affected for r in dq_report(spark, MIDDLE).collect()}
    assert counts == {
        "No fully empty rows": 0,
        "ORDER_ID not null": 295,
        "CUSTOMER_ID not null": 1243,
        "No duplicate ORDER_IDs": 14385,
        "QUANTITY > 0": 637,
        "UNIT_PRICE > 0": 1232,
        "STATUS valid enum": 21400,
        "CURRENCY valid": 20473,
        "TOTAL_AMOUNT = QTY * PRICE": 2639,
        "ORDER_DATE parseable": 586,
    }
    assert stage_latest(raw, AT).count() == 45615
    valid = {}
    for rule in ("strict", "lenient"):
        staged = stage_runs(raw, AT, "RUN_A", rule)
        rows, good, amount = staged.agg(
            F.count(F.lit(1)), F.count_if("_is_valid"), F.sum(F.when(F.col("_is_valid"), F.col("total_amount")))
        ).first()
        assert rows == 26014
        valid[rule] = good
        if rule == "strict":
            assert str(amount) == "572207652.7000"
    assert valid == {"strict": 24187, "lenient": 24947}
    raw.unpersist()
