import pytest
from pyspark.sql import functions as F

from ordermart.operators import expectations
from ordermart.operators.quality import (
    CHECKS,
    loadable_count,
    loadable_rows,
    overall,
    report_from_counts,
    row_counts,
    run_checks,
    summary_text,
)
from ordermart.schemas import DQ_REPORT, LANDING, STATUSES

CLEAN = [
    {},
    {"order_id": "ORD-002", "order_date": "2024-01-16", "quantity": "50", "unit_price": "45.50", "total_amount": "2275.00"},
    {
        "order_id": "ORD-003",
        "order_date": "2024-01-17",
        "quantity": "2",
        "unit_price": "8900.00",
        "total_amount": "17800.00",
        "status": "PENDING",
    },
]
DIRTY = [
    {"customer_id": None, "quantity": "0", "total_amount": "0.00"},
    {
        "order_date": "bad_date",
        "customer_id": "CUST-102",
        "quantity": "50",
        "unit_price": "-10.00",
        "total_amount": "2275.00",
        "currency": "XYZ",
        "status": "INVALID_STATUS",
    },
    {
        "order_id": None,
        "order_date": "2024-01-17",
        "customer_id": "CUST-103",
        "quantity": "2",
        "unit_price": "8900.00",
        "total_amount": "17800.00",
        "status": "PENDING",
    },
]


def affected(report):
    return {r.check_name: r.rows_affected for r in report.collect()}


def count_of(df, key):
    return affected(run_checks(df, "T"))[CHECKS[key][0]]


def test_clean_orders_pass_everything(orders):
    report = run_checks(orders(*CLEAN), "TEST_001")
    rows = report.collect()
    assert len(rows) == 10 and all(r.passed and r.rows_affected == 0 and r.details == "" for r in rows)
    assert {(r.run_id, r.table_name, r.total_rows) for r in rows} == {("TEST_001", "RAW_SALES_ORDERS", 3)}
    assert report.columns == DQ_REPORT.names
    assert overall(report).first().asDict() == {"passed": True, "pass_rate": 100.0, "failed_checks": ""}


def test_dirty_orders_fail_nine_checks_with_one_row_each(orders):
    report = run_checks(orders(*DIRTY), "TEST_010")
    counts = affected(report)
    assert counts.pop("No fully empty rows") == 0
    assert set(counts.values()) == {1} and len(counts) == 9
    result = overall(report).first()
    assert not result.passed and result.pass_rate == pytest.approx(10.0)
    assert "CUSTOMER_ID not null" in result.failed_checks
    details = {r.check_name: r.details for r in report.collect()}
    assert details["STATUS valid enum"] == "1 rows with invalid STATUS value"


def test_empty_input_passes(spark):
    report = run_checks(spark.createDataFrame([], LANDING), "T")
    assert set(affected(report).values()) == {0}
    assert {r.total_rows for r in report.collect()} == {0}
    assert overall(report).first().pass_rate == 100.0


def test_no_checks_mean_rate_zero(orders):
    report = run_checks(orders({}), "T").where("false")
    assert overall(report).first().asDict() == {"passed": True, "pass_rate": 0.0, "failed_checks": ""}


def test_fully_empty_row_also_in_a_raw_table(spark, orders):
    empty = spark.createDataFrame([(None,) * 16], LANDING)
    df = orders({}).unionByName(empty)
    assert count_of(df, "empty_rows") == 1
    assert count_of(df.withColumn("_pipeline_run_id", F.lit("R")), "empty_rows") == 1


def test_nulls_count_as_equal_repeats(orders):
    rows = [{"order_id": x} for x in ("A", "A", None, None)]
    assert count_of(orders(*rows), "order_id_repeats") == 2


def test_codes_are_upper_cased_but_not_trimmed(orders):
    rows = [{"status": s, "currency": c} for s, c in [("completed", "eur"), (" cancelled", " GBP"), (None, None)]]
    assert count_of(orders(*rows), "status_code") == 2
    assert count_of(orders(*rows), "currency_code") == 2


def test_unparseable_numbers_are_not_out_of_range(orders):
    rows = [{"quantity": q} for q in ("ten", None, "NaN", "0", "-1", "0.4")]
    assert count_of(orders(*rows), "quantity_range") == 2


def test_amount_tolerance_and_missing_operands(orders):
    totals = ["12500.00", "12500.01", "12500.02", "12499.98", None, "x"]
    assert count_of(orders(*[{"total_amount": t} for t in totals]), "amount_mismatch") == 2
    assert count_of(orders({"quantity": None}, {"unit_price": "NaN"}), "amount_mismatch") == 0


def test_product_beyond_decimal_range_is_a_mismatch(orders):
    huge = {"quantity": "9" * 25, "unit_price": "9" * 25, "total_amount": "1"}
    assert count_of(orders(huge), "amount_mismatch") == 1


def test_missing_column_raises(orders):
    for column in ("quantity", "unit_price", "total_amount", "order_id", "status"):
        with pytest.raises(Exception, match=column):
            run_checks(orders({}).drop(column), "T").collect()


def test_upper_case_columns_are_accepted(orders):
    df = orders(*DIRTY)
    assert affected(run_checks(df.toDF(*[c.upper() for c in df.columns]), "T")) == affected(run_checks(df, "T"))


def test_report_from_observed_counts_is_the_same(orders):
    df = orders(*DIRTY)
    counts = df.agg(*row_counts(df), loadable_count().alias("loadable")).first().asDict()
    assert affected(report_from_counts(df, counts, "T")) == affected(run_checks(df, "T"))


def test_loadable_rows_need_order_and_product(orders):
    df = orders({}, {"order_id": None}, {"product_id": None}, {"quantity": "x"})
    assert loadable_rows(df).first().loadable_rows == 2


def test_summary_text(orders):
    text = summary_text(run_checks(orders(*DIRTY), "TEST_1").collect())
    assert "RAW_SALES_ORDERS" in text and "TEST_1" in text and "3 rows" in text
    assert "FAILED, score 10.0%" in text and "1 duplicate order IDs" in text
    assert "PASSED, score 100.0%" in summary_text(run_checks(orders(*CLEAN), "T").collect())


def test_declarative_tests(spark, orders):
    df = orders(
        {"order_id": "A", "status": "COMPLETED"},
        {"order_id": "A", "status": "LOST"},
        {"order_id": None, "status": None},
        {"order_id": None, "status": "PENDING"},
    )
    assert expectations.not_null(df, "order_id").count() == 2
    assert [tuple(r) for r in expectations.unique(df, "order_id").collect()] == [("A", 2)]
    assert [r.status for r in expectations.accepted_values(df, "status", STATUSES).collect()] == ["LOST"]


def test_orphans_skip_nulls_and_keep_every_row(spark):
    child = spark.createDataFrame([(1, 10), (2, 10), (3, 20), (4, None)], "id int, fk long")
    parent = spark.createDataFrame([(20,), (30,)], "sk long")
    assert sorted(r.id for r in expectations.orphans(child, "fk", parent, "sk").collect()) == [1, 2]


def test_duplicate_rows_by_hash(raw):
    df = raw({}, {}, {}, {"order_id": "B"})
    rows = expectations.duplicate_rows(df).collect()
    assert len(rows) == 1 and rows[0].extra_rows == 2
