"""Raw to staging, per run and incremental."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermart.functions.columns import DATE_FORMATS
from ordermart.operators.cleaning import clean_orders
from ordermart.operators.latest import latest_ingest, latest_per_key


def of_run(df: DataFrame, run_id: str) -> DataFrame:
    """Rows of one run; prunes partitions where the table is partitioned by run."""
    return df.where(F.col("_pipeline_run_id") == F.lit(run_id))


def _latest_cleaned(
    raw: DataFrame,
    keys: Sequence[str],
    transformed_at: datetime,
    rule: str,
    date_formats: Sequence[str],
) -> DataFrame:
    """Clean, then keep the latest row per key.

    Cleaning passes keys and ingest time through, so the order of the two does not change
    the result; done first, it runs once, on the map side, and the shuffle carries typed
    values. The row hash rides along to settle ties, as bytes: their order is that of the
    digits and they take half the room.
    """
    cleaned = clean_orders(raw, transformed_at, rule, date_formats, keep=["_row_hash"])
    digits = F.col("_row_hash")
    cleaned = cleaned.withColumn("_row_hash", F.coalesce(F.unhex(digits), F.encode(digits, "UTF-8")))
    return latest_per_key(cleaned, keys, latest_ingest()).drop("_row_hash")


def stage_runs(
    raw: DataFrame,
    transformed_at: datetime,
    run_id: str | None = None,
    rule: str = "strict",
    date_formats: Sequence[str] = DATE_FORMATS,
) -> DataFrame:
    """Latest row per order within each run, cleaned and flagged; one run, or all of them."""
    rows = raw if run_id is None else of_run(raw, run_id)
    return _latest_cleaned(rows, ["_pipeline_run_id", "order_id"], transformed_at, rule, date_formats)


def stage_latest(
    raw: DataFrame,
    transformed_at: datetime,
    rule: str = "lenient",
    date_formats: Sequence[str] = DATE_FORMATS,
) -> DataFrame:
    """Latest row per order over all given rows, cleaned and flagged."""
    return _latest_cleaned(raw, ["order_id"], transformed_at, rule, date_formats)


def high_watermark(target: DataFrame) -> datetime | None:
    """Newest ingest time in ``target``, None when it is empty."""
    return target.agg(F.max("_ingested_at")).first()[0]


def newer_than(raw: DataFrame, watermark: datetime | None) -> DataFrame:
    """Rows ingested after the watermark; all rows when there is none.

    The watermark is a literal, so it reaches the scan and skips row groups by statistics.
    """
    if watermark is None:
        return raw
    return raw.where(F.col("_ingested_at") > F.lit(watermark.isoformat()).cast("timestamp_ntz"))


def merge_by_key(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Batch rows replace target rows with the same key; a NULL key matches nothing."""
    return target.join(batch.select(key), key, "left_anti").unionByName(batch)
