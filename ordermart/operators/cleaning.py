"""Cleaning, typing and the validity flag."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermart.functions.columns import (
    DATE_FORMATS,
    as_decimal,
    blank_to_null,
    clean_code,
    clean_name,
    clean_text,
    strict_date,
)
from ordermart.schemas import STAGING


def validity(rule: str = "strict") -> Column:
    """Validity of a typed row.

    ``strict``: date present, quantity and price present and above zero.
    ``lenient``: date and quantity present, price not at or below zero; a quantity of zero
    and a missing price pass.
    """
    quantity, price = F.col("quantity"), F.col("unit_price")
    if rule == "strict":
        broken = quantity.isNull() | (quantity <= 0) | price.isNull() | (price <= 0)
    elif rule == "lenient":
        broken = quantity.isNull() | (price <= 0)
    else:
        raise ValueError(f"unknown validity rule: {rule}")
    return F.when(F.col("order_date").isNull() | broken, F.lit(False)).otherwise(F.lit(True))


def clean_orders(
    raw: DataFrame,
    transformed_at: datetime,
    rule: str = "strict",
    date_formats: Sequence[str] = DATE_FORMATS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Raw text rows to typed staging rows; nothing is dropped, broken rows are flagged.

    ``keep`` names raw columns to carry along behind the staging columns.
    """
    typed = raw.select(
        "order_id",
        strict_date(F.col("order_date"), date_formats).alias("order_date"),
        blank_to_null(F.col("customer_id")).alias("customer_id"),
        clean_name(F.col("customer_name")).alias("customer_name"),
        "product_id",
        clean_text(F.col("product_name")).alias("product_name"),
        clean_code(F.col("category")).alias("category"),
        as_decimal(F.col("quantity"), 10, 0).alias("quantity"),
        as_decimal(F.col("unit_price"), 18, 4).alias("unit_price"),
        as_decimal(F.col("total_amount"), 18, 4).alias("total_amount"),
        *[
            clean_code(F.col(name)).alias(name)
            for name in ("currency", "region", "plant_code", "sap_document_type", "status")
        ],
        "_pipeline_run_id",
        "_ingested_at",
        F.lit(transformed_at.replace(tzinfo=None).isoformat()).cast("timestamp_ntz").alias("_transformed_at"),
        *keep,
    )
    return typed.withColumn("_is_valid", validity(rule)).select(*STAGING.names, *keep)
