"""Ten data-quality checks on raw order rows and the report made of them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ordermart.functions.columns import DATE_FORMATS, as_decimal, in_values, strict_date
from ordermart.schemas import CURRENCIES, INGEST_COLUMNS, STATUSES

# Check names, in report order, and the text that follows the row count.
CHECKS = {
    "empty_rows": ("No fully empty rows", "fully null rows found"),
    "order_id_null": ("ORDER_ID not null", "rows missing ORDER_ID"),
    "customer_id_null": ("CUSTOMER_ID not null", "rows missing CUSTOMER_ID"),
    "order_id_repeats": ("No duplicate ORDER_IDs", "duplicate order IDs"),
    "quantity_range": ("QUANTITY > 0", "rows with quantity <= 0"),
    "price_range": ("UNIT_PRICE > 0", "rows with unit_price <= 0"),
    "status_code": ("STATUS valid enum", "rows with invalid STATUS value"),
    "currency_code": ("CURRENCY valid", "rows with unexpected currency"),
    "amount_mismatch": ("TOTAL_AMOUNT = QTY * PRICE", "rows with amount mismatch"),
    "date_unparseable": ("ORDER_DATE parseable", "rows with invalid date format"),
}
REPEATS = "order_id_repeats"
TOLERANCE = "0.01"


def _number(name: str) -> Column:
    return as_decimal(F.col(name), 38, 10)


def _amount_mismatch() -> Column:
    """Total and product differ; rows with a missing operand are not judged.

    A product too large for a decimal cannot equal a total that fits, so it counts.
    """
    quantity, price, total = _number("quantity"), _number("unit_price"), _number("total_amount")
    judged = quantity.isNotNull() & price.isNotNull() & total.isNotNull()
    gap = F.abs(F.try_subtract(total, F.try_multiply(quantity, price)))
    return judged & F.coalesce(gap > F.lit(TOLERANCE).cast("decimal(3,2)"), F.lit(True))


def row_counts(df: DataFrame, date_formats: Sequence[str] = DATE_FORMATS) -> list[Column]:
    """Total rows and the nine counts that need no grouping, for ``agg`` or ``observe``.

    A row is empty when every business column is NULL; ingest columns never are and do not
    take part. A missing column raises.
    """
    business = [name for name in df.columns if name.lower() not in INGEST_COLUMNS]
    broken = {
        "empty_rows": reduce(Column.__and__, [F.col(name).isNull() for name in business]),
        "order_id_null": F.col("order_id").isNull(),
        "customer_id_null": F.col("customer_id").isNull(),
        "quantity_range": _number("quantity") <= 0,
        "price_range": _number("unit_price") <= 0,
        "status_code": ~in_values(F.upper("status"), STATUSES),
        "currency_code": ~in_values(F.upper("currency"), CURRENCIES),
        "amount_mismatch": _amount_mismatch(),
        "date_unparseable": strict_date(F.col("order_date"), date_formats).isNull(),
    }
    return [
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(condition).alias(name) for name, condition in broken.items()],
    ]


def loadable_count() -> Column:
    """Rows that carry both an order id and a product id."""
    return F.count_if(F.col("order_id").isNotNull() & F.col("product_id").isNotNull())


def loadable_rows(df: DataFrame) -> DataFrame:
    return df.agg(loadable_count().alias("loadable_rows"))


def repeat_counts(df: DataFrame, column: str, name: str) -> DataFrame:
    """Total rows and occurrences after the first per value; NULLs count as equal."""
    per_value = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    return per_value.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias(name),
    )


def _as_report(counts: DataFrame, run_id: str, table_name: str) -> DataFrame:
    """Turn one row of counts into one report row per counted check."""
    checks = [
        F.struct(F.lit(title).alias("check_name"), F.col(name).alias("rows_affected"), F.lit(text).alias("text"))
        for name, (title, text) in CHECKS.items()
        if name in counts.columns
    ]
    affected = F.col("rows_affected")
    return counts.select("total_rows", F.inline(F.array(*checks))).select(
        F.lit(run_id).alias("run_id"),
        F.lit(table_name).alias("table_name"),
        F.col("total_rows").cast("long").alias("total_rows"),
        "check_name",
        (affected == 0).alias("passed"),
        affected.cast("long").alias("rows_affected"),
        F.when(affected > 0, F.concat_ws(" ", affected.cast("string"), F.col("text")))
        .otherwise(F.lit(""))
        .alias("details"),
    )


def run_checks(
    df: DataFrame,
    run_id: str,
    table_name: str = "RAW_SALES_ORDERS",
    date_formats: Sequence[str] = DATE_FORMATS,
) -> DataFrame:
    """Report of all checks, one row each.

    Nine counts come from one pass; the repeated order ids need a grouping, which reads
    that one column and combines equal ids before the shuffle.
    """
    single_pass = _as_report(df.agg(*row_counts(df, date_formats)), run_id, table_name)
    repeats = _as_report(repeat_counts(df, "order_id", REPEATS), run_id, table_name)
    return single_pass.unionByName(repeats)


def report_from_counts(
    loaded: DataFrame, counts: dict[str, int], run_id: str, table_name: str = "RAW_SALES_ORDERS"
) -> DataFrame:
    """The same report when the nine counts were already observed while loading.

    ``loaded`` is read again for its order ids only.
    """
    names = ["total_rows", *[name for name in CHECKS if name in counts]]
    row = loaded.sparkSession.createDataFrame(
        [tuple(counts[name] for name in names)], ", ".join(f"{name} long" for name in names)
    )
    repeats = _as_report(repeat_counts(loaded, "order_id", REPEATS), run_id, table_name)
    return _as_report(row, run_id, table_name).unionByName(repeats)


def overall(report: DataFrame) -> DataFrame:
    """One row: passed by all checks, pass rate in percent (0.0 without checks), failed names."""
    return report.agg(
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("passed"),
        F.coalesce(F.avg(F.col("passed").cast("int")) * 100, F.lit(0.0)).alias("pass_rate"),
        F.array_join(
            F.array_sort(F.collect_set(F.when(~F.col("passed"), F.col("check_name")))), ", "
        ).alias("failed_checks"),
    )


def summary_text(checks: list[Row]) -> str:
    """Readable report from the collected report rows, at most one per check."""
    order = {title: place for place, (title, _) in enumerate(CHECKS.values())}
    checks = sorted(checks, key=lambda row: order.get(row.check_name, len(order)))
    passed = sum(row.passed for row in checks)
    rate = 100.0 * passed / len(checks) if checks else 0.0
    verdict = "PASSED" if passed == len(checks) else "FAILED"
    lines = []
    if checks:
        first = checks[0]
        lines.append(f"Data quality of {first.table_name}, run {first.run_id}: {first.total_rows} rows")
    lines.append(f"{verdict}, score {rate:.1f}%")
    for row in checks:
        mark = "ok    " if row.passed else "FAILED"
        lines.append(f"  {mark} {row.check_name}: {row.details or row.rows_affected}")
    return "\n".join(lines)
