"""Columns added to landing rows on their way into the raw layer."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermart.functions.columns import row_hash
from ordermart.schemas import BUSINESS_COLUMNS


def with_ingest_metadata(
    df: DataFrame, run_id: str, ingested_at: datetime, source_file: Column | None = None
) -> DataFrame:
    """Stamp run id, ingest time (whole seconds, one value per run) and base file name."""
    if source_file is None:
        source_file = F.col("_metadata.file_name")
    return df.withColumns(
        {
            "_pipeline_run_id": F.lit(run_id),
            "_ingested_at": F.lit(ingested_at.replace(microsecond=0, tzinfo=None).isoformat()).cast("timestamp_ntz"),
            "_source_file": source_file,
        }
    )


def with_row_hash(df: DataFrame) -> DataFrame:
    return df.withColumn("_row_hash", row_hash(BUSINESS_COLUMNS))


def upper_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.upper() for name in df.columns])
