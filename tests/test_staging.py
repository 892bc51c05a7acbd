from datetime import datetime
from decimal import Decimal

import pytest

from ordermart.operators.cleaning import clean_orders
from ordermart.operators.staging import high_watermark, merge_by_key, newer_than, stage_latest, stage_runs
from ordermart.schemas import STAGING

AT = datetime(2024, 3, 1)
LATER = "2024-02-02 00:00:00"


def test_cleaning_makes_the_staging_contract(raw):
    df = clean_orders(
        raw({"customer_id": "  ", "customer_name": " BIG co ", "category": " he", "currency": "eur ", "product_id": " P ", "status": " cancelled"}),
        AT,
    )
    assert df.columns == STAGING.names
    assert [f.dataType for f in df.schema] == [f.dataType for f in STAGING]
    row = df.first()
    assert (row.customer_id, row.customer_name, row.category, row.currency) == (None, "Big Co", "HE", "EUR")
    assert (row.product_id, row.status, row.quantity) == (" P ", "CANCELLED", 10)
    assert row.unit_price == Decimal("1250.0000") and row._transformed_at == AT


@pytest.mark.parametrize(
    "change, strict, lenient",
    [
        ({}, True, True),
        ({"order_date": "bad_date"}, False, False),
        ({"order_date": "2024-1-5"}, False, False),
        ({"quantity": "ten"}, False, False),
        ({"quantity": None}, False, False),
        ({"quantity": "99999999999"}, False, False),
        ({"quantity": "0"}, False, True),
        ({"quantity": "0.4"}, False, True),
        ({"quantity": "-3"}, False, True),
        ({"unit_price": None}, False, True),
        ({"unit_price": "1,000"}, False, True),
        ({"unit_price": "0"}, False, False),
        ({"unit_price": "-10.00"}, False, False),
        ({"customer_id": None}, True, True),
        ({"status": "LOST"}, True, True),
    ],
)
def test_validity_rules(raw, change, strict, lenient):
    df = raw(change)
    assert clean_orders(df, AT, "strict").first()._is_valid is strict
    assert clean_orders(df, AT, "lenient").first()._is_valid is lenient


def test_unknown_rule_raises(raw):
    with pytest.raises(ValueError, match="unknown validity rule"):
        clean_orders(raw({}), AT, "loose")


def test_latest_row_per_order_within_each_run(raw):
    df = raw(
        {"status": "PENDING"},
        {"status": "COMPLETED", "_ingested_at": LATER},
        {"status": "FAILED", "_pipeline_run_id": "R2"},
        {"order_id": None, "quantity": "1"},
        {"order_id": None, "quantity": "2"},
    )
    rows = stage_runs(df, AT).collect()
    assert sorted((r._pipeline_run_id, r.order_id or "", r.status) for r in rows if r.order_id) == [
        ("R1", "ORD-001", "COMPLETED"),
        ("R2", "ORD-001", "FAILED"),
    ]
    assert sum(r.order_id is None for r in rows) == 1
    assert stage_runs(df, AT, "R2").count() == 1


def test_equal_times_are_settled_by_row_hash(raw):
    df = raw({"quantity": "1"}, {"quantity": "2"}, {"quantity": "3"})
    smallest = min(df.collect(), key=lambda r: r._row_hash)
    for partitions in (1, 3, 7):
        assert stage_latest(df.repartition(partitions), AT).first().quantity == int(smallest.quantity)


def test_watermark_and_merge(spark, raw):
    df = raw(
        {"order_id": "A", "status": "PENDING"},
        {"order_id": "B", "status": "PENDING"},
        {"order_id": "A", "status": "COMPLETED", "_ingested_at": LATER},
        {"order_id": "C", "status": "FAILED", "_ingested_at": LATER},
    )
    empty = spark.createDataFrame([], STAGING)
    assert high_watermark(empty) is None
    assert newer_than(df, None).count() == 4
    target = stage_latest(df.where("_ingested_at < '2024-02-02'"), AT)
    mark = high_watermark(target)
    assert mark == datetime(2024, 2, 1)
    batch = newer_than(df, mark)
    assert batch.count() == 2  # rows at the watermark itself are not read again
    merged = merge_by_key(target, stage_latest(batch, AT), "order_id")
    assert {r.order_id: r.status for r in merged.collect()} == {"A": "COMPLETED", "B": "PENDING", "C": "FAILED"}
