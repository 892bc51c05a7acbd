"""Pick up new landing files and keep ``stg_sales`` current."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from ordermart.functions.columns import DATE_FORMATS, missing_to_null
from ordermart.operators.ingest import with_ingest_metadata, with_row_hash
from ordermart.plans.closing import finish_closing, reopen_run
from ordermart.plans.deliveries import load_deliveries
from ordermart.plans.ingestion import load_raw
from ordermart.plans.runlog import utc_now
from ordermart.schemas import BUSINESS_COLUMNS, LANDING, Layers, closed_part, closed_runs
from ordermart.sinks.tables import overwrite_partitions, setup_raw, setup_staging
from ordermart.sources.landing import CORRUPT, LANDING_OPTIONS


def landing_stream(
    spark: SparkSession, directory: str, max_files: int | None = None, multi_line: bool = False
) -> DataFrame:
    """Stream of landing rows; each file is read once, with its name beside every row.

    Lines with too few or too many fields carry their text in ``_corrupt_record``.
    """
    marked = StructType([*LANDING.fields, StructField(CORRUPT, StringType())])
    reader = (
        spark.readStream.schema(marked)
        .options(**LANDING_OPTIONS)
        .option("multiLine", multi_line)
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(directory).select(
        *[missing_to_null(F.col(name)).alias(name) for name in BUSINESS_COLUMNS],
        CORRUPT,
        F.col("_metadata.file_name").alias("_source_file"),
    )


def load_batch(
    batch: DataFrame,
    run_id: str,
    layers: Layers = Layers(),
    rule: str = "lenient",
    date_formats: Sequence[str] = DATE_FORMATS,
) -> None:
    """Load one micro-batch into raw and upsert it into ``stg_sales``.

    The raw rows replace what an earlier attempt of the same run id wrote. That makes them a
    new delivery in place of the old one, and the run's rows are replaced in ``stg_sales``
    too, so a batch that Spark repeats after a failure leaves the tables as one attempt would.
    """
    spark = batch.sparkSession
    now = utc_now()
    rows = with_row_hash(with_ingest_metadata(batch, run_id, now, F.col("_source_file")))
    reopen_run(spark, layers.raw_sales_orders, run_id)
    load_raw(rows, layers, date_formats, overwrite_partitions)
    load_deliveries(spark, now, layers, rule, date_formats, run_id)


def stream_run_id(spark: SparkSession, name: str, number: int) -> str:
    """Run id of a micro-batch: its number within the stream that is running.

    The stream's own id is kept in its checkpoint: a restart continues it, and another or a
    renewed checkpoint has another id, so no stream replaces rows of another.
    """
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    if query is None:
        raise RuntimeError("a micro-batch is loaded outside of a stream")
    return f"{name}_{query.replace('-', '')}_{number:06d}"


def start_landing_stream(
    spark: SparkSession,
    directory: str,
    checkpoint_dir: str,
    name: str = "landing",
    layers: Layers = Layers(),
    rule: str = "lenient",
    max_files: int | None = None,
    multi_line: bool = False,
    date_formats: Sequence[str] = DATE_FORMATS,
) -> StreamingQuery:
    """Process the files that have arrived since the last start, then stop.

    Run ids are ``<name>_<id of the stream>_<batch number>``.
    """
    setup_raw(spark, layers)
    setup_staging(spark, layers)
    finish_closing(spark, layers)
    return (
        landing_stream(spark, directory, max_files, multi_line)
        .writeStream.foreachBatch(
            lambda batch, number: load_batch(
                batch, stream_run_id(batch.sparkSession, name, number), layers, rule, date_formats
            )
        )
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )


def run_landing_stream(
    spark: SparkSession, directory: str, checkpoint_dir: str, layers: Layers = Layers(), **options
) -> None:
    """Process the files that have arrived and return when they are loaded.

    Batches write from a session of their own, so the tables are refreshed for the caller.
    """
    start_landing_stream(spark, directory, checkpoint_dir, layers=layers, **options).awaitTermination()
    raw = layers.raw_sales_orders
    stored = (layers.stg_sales, layers.stg_sales_keys, layers.stg_sales_deliveries)
    for table in (raw, closed_part(raw), closed_runs(raw), *stored):
        spark.catalog.refreshTable(table)
