"""Registered queries: each runs library operators over the whole given tables.

Results leave as plain types (dates and times as text, decimals as doubles), so that two
engines can be compared by value.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, StructType, TimestampNTZType

from gate.inputs import raw_base, raw_orders
from ordermart.operators import expectations, quality
from ordermart.operators.calendar import calendar, calendar_rows, day_span
from ordermart.operators.dimensions import CUSTOMER, PRODUCT, dimension_rows, members
from ordermart.operators.facts import fact_rows
from ordermart.operators.ingest import upper_columns, with_ingest_metadata
from ordermart.operators.marts import product_sales, sales_summary
from ordermart.operators.staging import (
    high_watermark,
    merge_by_key,
    newer_than,
    of_run,
    stage_latest,
    stage_runs,
)
from ordermart.plans.batch import run_full_pipeline
from ordermart.plans.closing import close_runs, rows_by_run
from ordermart.plans.ingestion import load_raw, prepare, run_ingestion
from ordermart.plans.models import count_failures, refresh_product_sales, refresh_stg_sales
from ordermart.plans.runlog import run_log_row, utc_now
from ordermart.plans.transformation import run_transformations
from ordermart.schemas import (
    BUSINESS_COLUMNS,
    DIM_CUSTOMER,
    DIM_DATE,
    DIM_PRODUCT,
    FACT,
    STATUSES,
    Layers,
)
from ordermart.session import freeze, move_files, scratch_path
from ordermart.sinks.tables import file_ranges, partition_values, setup_raw
from ordermart.sources.landing import read_landing
from ordermart.streaming.landing import run_landing_stream

RUNS = ["RUN_A", "RUN_B"]
AT = datetime(2026, 1, 1)
SPLIT = datetime(2000, 1, 1)


def plain(df: DataFrame) -> DataFrame:
    """Dates and times as text, decimals as doubles."""
    columns = []
    for field in df.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (DateType, TimestampNTZType)):
            column = column.cast("string")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def _staged(df: DataFrame) -> DataFrame:
    return plain(df.drop("_transformed_at"))


def _empty(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def staging_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(stage_runs(raw_orders(spark, sf_dir), AT))


def staging_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(stage_latest(raw_orders(spark, sf_dir), AT))


def staging_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_orders(spark, sf_dir)
    early = raw.where(F.col("_ingested_at") <= F.lit(SPLIT).cast("timestamp_ntz"))
    target = freeze(stage_latest(early, AT), "stg_sales")
    batch = freeze(stage_latest(newer_than(raw, high_watermark(target)), AT), "stg_sales_batch")
    return _staged(merge_by_key(target, batch, "order_id"))


def row_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_orders(spark, sf_dir).select("order_id", "product_id", "_row_hash")


def ingest_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey")
    return plain(with_ingest_metadata(lines, "RUN_20260101_000000", AT))


def upper_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upper_columns(plain(raw_orders(spark, sf_dir)))


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.run_checks(raw_orders(spark, sf_dir), "RUN_ALL")


def dq_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.overall(dq_report(spark, sf_dir))


def loadable_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.loadable_rows(raw_orders(spark, sf_dir))


def test_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = expectations.not_null(raw_orders(spark, sf_dir), "customer_id")
    return rows.select("order_id", "product_id", "customer_id", "_row_hash")


def test_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expectations.unique(raw_orders(spark, sf_dir), "order_id")


def test_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = stage_latest(raw_orders(spark, sf_dir), AT)
    return expectations.accepted_values(staged, "status", STATUSES).select("order_id", "status")


def test_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged orders of all runs whose product the first run's dimension lacks."""
    staged = freeze(stage_runs(raw_orders(spark, sf_dir), AT), "staged")
    known = members(of_run(staged, RUNS[0]), *PRODUCT[:2])
    lost = expectations.orphans(staged, "product_id", known, "product_id")
    return lost.select("order_id", "product_id", "_pipeline_run_id")


def dup_by_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw rows plus a repeated delivery of one plant."""
    raw = freeze(raw_orders(spark, sf_dir), "raw")
    return expectations.duplicate_rows(raw.unionByName(raw.where(F.col("plant_code") == "pl1")))


@dataclass
class Star:
    staged: DataFrame
    dim_customer: DataFrame
    dim_product: DataFrame
    dim_date: DataFrame
    loads: list[DataFrame]

    @property
    def fact(self) -> DataFrame:
        fact = self.loads[0]
        for load in self.loads[1:]:
            fact = fact.unionByName(load)
        return fact


def _dimension_loads(spark: SparkSession, staged: DataFrame, definition, schema: StructType) -> DataFrame:
    key, attributes, surrogate = definition
    dimension = _empty(spark, schema)
    for run_id in RUNS:
        batch = of_run(staged, run_id)
        new = dimension_rows(batch, dimension, key, attributes, surrogate, AT.date())
        dimension = dimension.unionByName(new)
    return dimension


def build_star(spark: SparkSession, sf_dir: str) -> Star:
    """Load both runs one after the other, as two runs of the job would."""
    staged = freeze(stage_runs(raw_orders(spark, sf_dir), AT), "staged")
    dim_customer = _dimension_loads(spark, staged, CUSTOMER, DIM_CUSTOMER)
    dim_product = _dimension_loads(spark, staged, PRODUCT, DIM_PRODUCT)
    star = Star(staged, dim_customer, dim_product, calendar_rows(staged, _empty(spark, DIM_DATE)), [])
    for run_id in RUNS:
        stored = star.fact if star.loads else _empty(spark, FACT)
        star.loads.append(fact_rows(staged, stored, dim_customer, dim_product, run_id, AT))
    return star


def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = stage_runs(raw_orders(spark, sf_dir), AT)
    return plain(dimension_rows(staged, _empty(spark, DIM_CUSTOMER), *CUSTOMER, AT.date()))


def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = stage_runs(raw_orders(spark, sf_dir), AT)
    return plain(dimension_rows(staged, _empty(spark, DIM_PRODUCT), *PRODUCT, AT.date()))


def dim_merge_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, attributes, _ = CUSTOMER
    used = [key, *attributes, "_pipeline_run_id", "_ingested_at", "_is_valid"]
    staged = freeze(stage_runs(raw_orders(spark, sf_dir), AT).select(*used), "staged")
    return plain(_dimension_loads(spark, staged, CUSTOMER, DIM_CUSTOMER))


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return plain(calendar(day_span(orders.select(F.col("o_orderdate").cast("date")))))


def fact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(build_star(spark, sf_dir).fact)


def fact_second_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the second run adds; orders of the first run are skipped."""
    return plain(build_star(spark, sf_dir).loads[1])


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = build_star(spark, sf_dir)
    return plain(sales_summary(star.fact, star.dim_date, star.dim_customer, star.dim_product))


def product_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = build_star(spark, sf_dir)
    return plain(product_sales(star.fact, star.dim_product))


def natural_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest valid orders by region, category and status, without a star."""
    staged = stage_latest(raw_orders(spark, sf_dir), AT, rule="strict").where("_is_valid")
    return plain(
        staged.groupBy("region", "category", "status").agg(
            F.count(F.lit(1)).alias("order_count"),
            F.sum("quantity").alias("total_quantity"),
            F.sum("total_amount").alias("total_revenue"),
        )
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_orders(spark, sf_dir)
    counts = raw.agg(*quality.row_counts(raw), quality.loadable_count().alias("loadable")).first()
    report = quality.report_from_counts(raw, counts.asDict(), "RUN_ALL")
    metadata = {
        "run_id": "RUN_ALL",
        "start_time": "2026-01-01T00:00:00",
        "end_time": "2026-01-01T00:05:00",
        "status": "SUCCESS",
        "rows_ingested": counts.total_rows,
        "rows_transformed": counts.loadable,
        "dq_pass_rate": quality.overall(report).first().pass_rate,
    }
    row = run_log_row(spark, metadata)
    parsed = F.variant_get("metadata_json", "$.rows_ingested", "long").alias("metadata_rows_ingested")
    return plain(row.select(*[c for c in row.columns if c != "metadata_json"], parsed))


# A gzip file, and one with line breaks in its texts, is read by one task.
LANDING_ROWS = 250_000


def _write_landing(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """Landing files as a source system would leave them: header, quotes doubled, text untouched.

    They are compressed and of bounded length, so more rows make more files. With ``by`` there
    is a folder for each value of these columns.
    """
    bounded = {"maxRecordsPerFile": LANDING_ROWS, "zlib.compress.level": "BEST_SPEED"}
    df.select(*BUSINESS_COLUMNS, *by).write.mode("append").options(**bounded).partitionBy(*by).csv(
        path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, compression="gzip"
    )


def _land_runs(rows: DataFrame, root: str, runs: Column | None = None) -> dict[str, str]:
    """Run id → its folder of landing files; all are written in one pass over the rows.

    ``runs`` names the runs that deliver a row, by default its own.
    """
    own = F.array("_pipeline_run_id") if runs is None else runs
    _write_landing(rows.withColumn("delivery", F.explode(own)).where(F.col("delivery").isin(RUNS)), f"{root}/landing", ["delivery"])
    return {run_id: f"{root}/landing/delivery={run_id}" for run_id in RUNS}


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "landing")
    _write_landing(raw_base(spark, sf_dir), path)
    return read_landing(spark, path)


def _quoted(raw: DataFrame) -> DataFrame:
    """Product names with commas, quotes and line breaks."""
    return raw.withColumn("product_name", F.concat("product_name", F.lit(', "'), "category", F.lit('",\n'), "region"))


def csv_quoted_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "landing")
    _write_landing(_quoted(raw_base(spark, sf_dir)), path)
    return read_landing(spark, path, multi_line=True)


def ingestion_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of two ingestions, the second without a run id, beside the rows they left."""
    layers = _own_layers(spark)
    folders = _land_runs(_quoted(raw_base(spark, sf_dir)), layers.root)
    records = []
    for number, run_id in enumerate(RUNS):
        given = None if number else run_id
        found = run_ingestion(spark, folders[run_id], given, layers, multi_line=True)
        kept = [found[name] for name in ("run_id", "status", "rows_ingested", "rows_malformed", "raw_table_rows")]
        times = [found["start_time"], found["end_time"]]
        records.append((number, *kept, found["counts"]["loadable"], *times))
    record = spark.createDataFrame(
        records,
        "delivery int, run_id string, status string, rows_ingested long, rows_malformed long, "
        "raw_table_rows long, loadable long, start_time string, end_time string",
    )
    stored = spark.table(layers.raw_sales_orders).groupBy(F.col("_pipeline_run_id").alias("run_id"))
    stored = stored.agg(
        F.count(F.lit(1)).alias("stored_rows"),
        F.count_distinct("_row_hash").alias("row_hashes"),
        F.min("_ingested_at").alias("first"),
        F.max("_ingested_at").alias("last"),
    )
    # Rows are stamped in whole seconds.
    start, end = (F.date_trunc("second", F.col(name).cast("timestamp_ntz")) for name in ("start_time", "end_time"))
    return record.join(stored, "run_id").select(
        "delivery",
        F.when(F.col("run_id") == RUNS[0], "given").when(F.col("run_id").rlike(r"^RUN_\d{8}_\d{6}$"), "made").alias("id_kind"),
        "status",
        "rows_ingested",
        "rows_malformed",
        "raw_table_rows",
        "loadable",
        "stored_rows",
        "row_hashes",
        (F.col("first").between(start, end) & F.col("last").between(start, end)).alias("stamped_within_run"),
    )


def _own_layers(spark: SparkSession) -> Layers:
    """Layers nobody else uses, in a folder of their own."""
    tag = uuid.uuid4().hex
    return Layers(*[f"{name}_{tag}" for name in ("raw", "staging", "dwh", "metrics")], root=scratch_path(spark, "job"))


def _stored_orders(spark: SparkSession, layers: Layers) -> DataFrame:
    """``stg_sales`` without times; the id of a stream is left out of its run ids."""
    rows = plain(spark.table(layers.stg_sales).drop("_ingested_at", "_transformed_at", "_order_month"))
    return rows.withColumn("_pipeline_run_id", F.regexp_replace("_pipeline_run_id", "_[0-9a-f]{32}_", "_"))


def stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries through the landing stream, one start each."""
    layers = _own_layers(spark)
    for run_id, folder in _land_runs(raw_base(spark, sf_dir), f"{layers.root}/outbox").items():
        # The files of both runs have the same names.
        move_files(spark, folder, f"{layers.root}/landing", f"{run_id}-")
        run_landing_stream(spark, f"{layers.root}/landing", f"{layers.root}/progress", layers)
    return _stored_orders(spark, layers)


def stream_two_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two folders with a checkpoint each, by streams of the same name."""
    layers = _own_layers(spark)
    for run_id, folder in _land_runs(raw_base(spark, sf_dir), layers.root).items():
        run_landing_stream(spark, folder, f"{layers.root}/progress-{run_id}", layers)
    return _stored_orders(spark, layers)


def _land_deliveries(spark: SparkSession, sf_dir: str, layers: Layers) -> dict[str, str]:
    """A landing folder for each run; the second delivers one plant of the first again."""
    again = (F.col("_pipeline_run_id") == RUNS[0]) & (F.col("plant_code") == "pl1")
    runs = F.when(again, F.array(*map(F.lit, RUNS))).otherwise(F.array("_pipeline_run_id"))
    return _land_runs(raw_base(spark, sf_dir), layers.root, runs)


def _refresh_in_order(spark: SparkSession, sf_dir: str, order: list[str]) -> DataFrame:
    """Load and refresh run by run; RUN_B was ingested a day after RUN_A whenever it is loaded."""
    layers = _own_layers(spark)
    folders = _land_deliveries(spark, sf_dir, layers)
    setup_raw(spark, layers)
    for run_id in order:
        load_raw(prepare(spark, folders[run_id], run_id, AT + timedelta(days=RUNS.index(run_id))), layers)
        refresh_stg_sales(spark, AT, layers)
    return _stored_orders(spark, layers)


def model_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refresh_in_order(spark, sf_dir, RUNS)


def late_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older run arrives after the newer one has been refreshed."""
    return _refresh_in_order(spark, sf_dir, RUNS[::-1])


def second_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run id gets two deliveries with a refresh after each; a third finds nothing to do."""
    layers = _own_layers(spark)
    folders = _land_deliveries(spark, sf_dir, layers)
    setup_raw(spark, layers)
    for day, folder in enumerate(folders.values()):
        load_raw(prepare(spark, folder, RUNS[0], AT + timedelta(days=day)), layers)
        refresh_stg_sales(spark, AT, layers)
    refresh_stg_sales(spark, AT, layers)
    return _stored_orders(spark, layers)


def _run_job(spark: SparkSession, sf_dir: str) -> Layers:
    layers = _own_layers(spark)
    for run_id, folder in _land_runs(raw_base(spark, sf_dir), layers.root).items():
        run_full_pipeline(spark, folder, run_id, layers)
    return layers


def pipeline_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored summary after the whole job has run for both deliveries."""
    return plain(spark.table(_run_job(spark, sf_dir).sales_summary))


def pipeline_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(spark.table(_run_job(spark, sf_dir).fact_sales_orders).drop("_loaded_at"))


def clustered_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layout of staging and fact by run, from their files: rows, key range, overlapping files."""
    layers = _run_job(spark, sf_dir)
    found = None
    for table, key in ((layers.stg_sales_orders, F.date_format("order_date", "yyyyMMdd").cast("int")), (layers.fact_sales_orders, F.col("date_key"))):
        part = file_ranges(spark.table(table).withColumn("day", key), "day", "_pipeline_run_id")
        before = F.lag("high").over(Window.partitionBy("_pipeline_run_id").orderBy("low", "high"))
        part = part.withColumn("overlaps", F.coalesce((F.col("low") < before).cast("int"), F.lit(0)))
        part = part.groupBy("_pipeline_run_id").agg(
            F.sum("n_rows").alias("n_rows"),
            F.min("low").alias("first_day"),
            F.max("high").alias("last_day"),
            F.sum("overlaps").alias("overlapping_files"),
        )
        part = part.withColumn("table_name", F.lit(table.split(".")[1]))
        found = part if found is None else found.unionByName(part)
    return found


def closed_run_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of both runs in every table, after each has been closed and the first staged again."""
    layers = _own_layers(spark)
    for run_id, folder in _land_runs(raw_base(spark, sf_dir), layers.root).items():
        run_full_pipeline(spark, folder, run_id, layers)
        close_runs(spark, utc_now() + timedelta(days=1), layers)
    run_transformations(spark, RUNS[0], AT, layers)
    refresh_stg_sales(spark, AT, layers)
    count = F.count(F.lit(1))
    run = "_pipeline_run_id"
    result = rows_by_run(spark, layers.raw_sales_orders).groupBy(run)
    result = result.agg(count.alias("raw_rows"), F.count_distinct("_row_hash").alias("row_hashes"))
    staged = rows_by_run(spark, layers.stg_sales_orders).groupBy(run).agg(
        count.alias("staged_rows"),
        F.count_if("_is_valid").alias("valid_rows"),
        F.sum("total_amount").cast("double").alias("total_amount"),
    )
    fact = spark.table(layers.fact_sales_orders).groupBy(run).agg(count.alias("fact_rows"))
    stored = spark.table(layers.stg_sales).groupBy(run).agg(count.alias("latest_rows"))
    for part in (staged, fact, stored):
        result = result.join(part, run)
    for table, name in ((layers.raw_sales_orders, "raw_folders"), (layers.stg_sales_orders, "staging_folders")):
        result = result.withColumn(name, F.col(run).isin(partition_values(spark, table, run)).cast("int"))
    return result


def run_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log rows of both runs, with the rows their steps left in raw and staging."""
    layers = _run_job(spark, sf_dir)
    step = F.variant_get("metadata_json", "$.steps.staging_to_fact", "string")
    rows = spark.table(layers.pipeline_run_log).select(
        F.col("run_id").alias("_pipeline_run_id"),
        "pipeline_name",
        "status",
        "rows_ingested",
        "rows_transformed",
        "error_message",
        step.alias("fact_step"),
    )
    for table, name in ((layers.raw_sales_orders, "raw_rows"), (layers.stg_sales_orders, "staged_rows")):
        counts = spark.table(table).groupBy("_pipeline_run_id").agg(F.count(F.lit(1)).alias(name))
        rows = rows.join(counts, "_pipeline_run_id")
    return rows


def fact_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of failing rows of every declared test, after the job and the models."""
    layers = _run_job(spark, sf_dir)
    refresh_stg_sales(spark, AT, layers)
    refresh_product_sales(spark, layers)
    found = count_failures(spark, layers)
    return spark.createDataFrame(list(found.items()), "test string, failing long")


QUERIES = {
    "staging_strict": staging_strict,
    "staging_lenient": staging_lenient,
    "staging_incremental": staging_incremental,
    "row_hash": row_hash,
    "ingest_metadata": ingest_metadata,
    "upper_columns": upper_names,
    "dq_report": dq_report,
    "dq_overall": dq_overall,
    "loadable_rows": loadable_rows,
    "test_not_null": test_not_null,
    "test_unique": test_unique,
    "test_accepted_values": test_accepted_values,
    "test_orphans": test_orphans,
    "dup_by_hash": dup_by_hash,
    "dim_customer": dim_customer,
    "dim_product": dim_product,
    "dim_merge_insert_only": dim_merge_insert_only,
    "dim_date": dim_date,
    "fact_orders": fact_orders,
    "fact_second_run": fact_second_run,
    "sales_summary": summary,
    "product_sales": product_rollup,
    "natural_summary": natural_summary,
    "run_log": run_log,
    "csv_roundtrip": csv_roundtrip,
    "csv_quoted_text": csv_quoted_text,
    "ingestion_records": ingestion_records,
    "stream_landing": stream_landing,
    "stream_two_sources": stream_two_sources,
    "model_refresh": model_refresh,
    "late_run": late_run,
    "second_delivery": second_delivery,
    "pipeline_run": pipeline_run,
    "pipeline_fact": pipeline_fact,
    "clustered_tables": clustered_tables,
    "closed_run_rows": closed_run_rows,
    "run_metadata": run_metadata,
    "declared_tests": fact_references,
}
