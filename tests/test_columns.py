from datetime import date
from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ordermart.functions import columns as c


def column_of(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_strict_date_takes_one_format_only(spark):
    texts = ["2024-01-15", "2024-1-5", "2024-02-30", " 2024-01-15 ", "20240115", "bad_date", None]
    assert column_of(spark, texts, c.strict_date) == [date(2024, 1, 15)] + [None] * 6


def test_strict_date_format_list(spark):
    parse = lambda x: c.strict_date(x, ["yyyy-MM-dd", "dd.MM.yyyy"])
    assert column_of(spark, ["15.01.2024", "2024-01-15"], parse) == [date(2024, 1, 15)] * 2


def test_decimal_rounds_half_up_and_never_raises(spark):
    texts = ["0.4", "2.5", "1e3", "1.0d", "NaN", "1,000", "ten", "99999999999", None]
    expected = [0, 3, 1000, None, None, None, None, None, None]
    assert column_of(spark, texts, lambda x: c.as_decimal(x, 10, 0)) == expected
    assert column_of(spark, ["45.50"], lambda x: c.as_decimal(x, 18, 4)) == [Decimal("45.5000")]


def test_text_cleaning(spark):
    assert column_of(spark, ["  ", " a ", "", None], c.blank_to_null) == [None, "a", None, None]
    assert column_of(spark, [" big DEALER de "], c.clean_name) == ["Big Dealer De"]
    assert column_of(spark, [" cancelled"], c.clean_code) == ["CANCELLED"]
    assert column_of(spark, ["NA", "null", "None", "n/a", "", "x", None], c.missing_to_null) == [None] * 5 + ["x", None]


def test_membership_is_false_for_null(spark):
    assert column_of(spark, ["EUR", "XYZ", None], lambda x: c.in_values(x, ["EUR"])) == [True, False, False]


def test_date_key(spark):
    assert column_of(spark, [date(2024, 1, 5), None], c.date_key, "date") == [20240105, None]


# The md5 of the values joined by "|", computed independently.
def reference_hash(values):
    import hashlib

    return hashlib.md5("|".join("nan" if v is None else v for v in values).encode()).hexdigest()


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(*[st.one_of(st.none(), st.text(st.characters(exclude_categories=["Cs"], exclude_characters="\0"), max_size=8))] * 3), min_size=1, max_size=20))
def test_row_hash_matches_md5_of_joined_text(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string, c string")
    got = [r[0] for r in df.orderBy("i").select(c.row_hash(["a", "b", "c"])).collect()]
    assert got == [reference_hash(r) for r in rows]
