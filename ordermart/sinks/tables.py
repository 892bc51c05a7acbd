"""Creating layer databases and tables, and writing to them."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ordermart.schemas import (
    CLOSED_RUNS,
    DELIVERIES,
    DIM_CUSTOMER,
    DIM_DATE,
    DIM_PRODUCT,
    DQ_REPORT,
    FACT,
    KEY_COUNTS,
    ORDER_IDS,
    ORDER_MONTHS,
    PRODUCT_SALES,
    RAW,
    RUN_LOG,
    SALES_SUMMARY,
    SALES_TOTALS,
    STAGING,
    STEPS,
    Layers,
    closed_part,
    closed_runs,
)
from ordermart.session import CODEC, folder_bytes, folder_exists, frozen, full_path, remove_folder, subfolders

RUN = "_pipeline_run_id"
MONTH = "_order_month"
DAY = "_closed_day"
NO_MONTH = "none"

_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
_OPEN_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
OPEN_FILES = 4


def database_path(spark: SparkSession, name: str, root: str | None) -> str:
    if root:
        return f"{full_path(spark, root)}/{name}"
    return f"{full_path(spark, spark.conf.get('spark.sql.warehouse.dir'))}/{name}.db"


def ensure_database(spark: SparkSession, name: str, root: str | None = None) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{database_path(spark, name, root)}'")


def ensure_table(
    spark: SparkSession,
    table: str,
    schema: StructType,
    partition_by: Sequence[str] = (),
    root: str | None = None,
) -> None:
    """Declare a table at its folder; what an earlier process left there belongs to it."""
    if spark.catalog.tableExists(table):
        return
    folder = table_folder(spark, table, root)
    held = folder_exists(spark, folder)
    partitions = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    declare(spark, table, schema, partitions, folder)
    if partition_by and held:
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")


def table_folder(spark: SparkSession, table: str, root: str | None = None) -> str:
    database, name = table.split(".")
    return f"{database_path(spark, database, root)}/{name}"


def declare(spark: SparkSession, table: str, schema: StructType, layout: str, folder: str) -> None:
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
    stored = f"USING parquet OPTIONS (compression '{CODEC}')"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) {stored}{layout} LOCATION '{folder}'")


# A table of keys lies in buckets, in a folder of its own for each version: ``v3-b32`` is the
# third rewrite, in 32 buckets. A version counts once its first write has been committed.
_VERSION = re.compile(r"v(\d+)-b(\d+)$")
# Files of a bucket beyond which they are merged.
MERGE_FILES = 16


def ensure_keys(
    spark: SparkSession, table: str, schema: StructType, key: str, buckets: int, root: str | None = None
) -> None:
    """Declare a table of keys at its latest complete version; ``buckets`` are those of the first."""
    if spark.catalog.tableExists(table):
        return
    home = table_folder(spark, table, root)
    versions = {}
    for folder in subfolders(spark, home):
        version = _VERSION.search(folder)
        if version:
            versions[int(version[1])] = (int(version[2]), folder)
    complete = [n for n, (_, folder) in versions.items() if folder_exists(spark, f"{folder}/_SUCCESS")]
    number = max(complete, default=min(versions, default=0))
    count, folder = versions.get(number, (buckets, f"{home}/v0-b{buckets}"))
    _declare_keys(spark, table, schema, key, count, folder)


def _declare_keys(spark: SparkSession, table: str, schema: StructType, key: str, buckets: int, folder: str) -> None:
    declare(spark, table, schema, f" CLUSTERED BY (`{key}`) INTO {buckets} BUCKETS", folder)


def bucket_count(spark: SparkSession, table: str) -> int:
    rows = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Num Buckets'").collect()
    return int(rows[0].data_type)


def append_keys(keys: DataFrame, table: str, key: str) -> None:
    """Append keys, one file for each bucket that gets any; only the new keys are shuffled."""
    append_table(keys.repartition(bucket_count(keys.sparkSession, table), key), table)


def rewrite_keys(keys: DataFrame, table: str, key: str, buckets: int) -> None:
    """Put ``keys``, which may come from the table, in place of its contents.

    They are written as a new version beside the old one; a rewrite that stops halfway
    leaves the old one in use.
    """
    spark = keys.sparkSession
    old = table_path(spark, table)
    version = _VERSION.search(old)
    number = int(version[1]) + 1 if version else 1
    folder = f"{old[: version.start()].rstrip('/') if version else old}/v{number}-b{buckets}"
    remove_folder(spark, folder)
    schema = spark.table(table).schema
    coming = f"{table}_next"
    spark.sql(f"DROP TABLE IF EXISTS {coming}")
    _declare_keys(spark, coming, schema, key, buckets, folder)
    append_keys(keys, coming, key)
    spark.sql(f"DROP TABLE {coming}")
    spark.sql(f"DROP TABLE {table}")
    _declare_keys(spark, table, schema, key, buckets, folder)
    if version:
        remove_folder(spark, old)


def grow_keys(spark: SparkSession, table: str, key: str, bucket_rows: int, coming: int = 0) -> int:
    """Double the buckets until none holds more than ``bucket_rows`` on average; merge many files.

    Doubling keeps the cost of all rewrites within a few times the final size. Row counts
    come from file footers, file names from the listing. ``coming`` are rows about to be
    appended: with room made for them first, a large load is not rewritten behind its append.
    Returns the number of buckets.
    """
    held, buckets = spark.table(table), bucket_count(spark, table)
    wanted, rows = buckets, held.count() + coming
    while rows > wanted * bucket_rows:
        wanted *= 2
    if wanted > buckets or len(held.inputFiles()) > MERGE_FILES * buckets:
        rewrite_keys(held.distinct(), table, key, wanted)
    return wanted


def ensure_by_run(spark: SparkSession, table: str, schema: StructType, root: str | None) -> None:
    """A table with a partition for each run, and its closed runs with a partition for each day."""
    ensure_table(spark, table, schema, [RUN], root)
    closed = StructType([*schema.fields, StructField("_delivery", StringType()), StructField(DAY, StringType())])
    ensure_table(spark, closed_part(table), closed, [DAY], root)
    ensure_table(spark, closed_runs(table), CLOSED_RUNS, (), root)


def setup_raw(spark: SparkSession, layers: Layers) -> None:
    ensure_database(spark, layers.raw, layers.root)
    ensure_by_run(spark, layers.raw_sales_orders, RAW, layers.root)
    ensure_table(spark, layers.raw_counted_deliveries, DELIVERIES, (), layers.root)
    ensure_keys(spark, layers.raw_key_counts, KEY_COUNTS, "key", layers.order_buckets, layers.root)


def setup_staging(spark: SparkSession, layers: Layers) -> None:
    ensure_database(spark, layers.staging, layers.root)
    ensure_by_run(spark, layers.stg_sales_orders, STAGING, layers.root)
    by_month = StructType([*STAGING.fields, StructField(MONTH, StringType())])
    ensure_table(spark, layers.stg_sales, by_month, [MONTH], layers.root)
    ensure_table(spark, layers.stg_sales_deliveries, DELIVERIES, (), layers.root)
    ensure_keys(spark, layers.stg_sales_keys, ORDER_MONTHS, "order_id", layers.order_buckets, layers.root)


def setup_dwh(spark: SparkSession, layers: Layers) -> None:
    ensure_database(spark, layers.dwh, layers.root)
    ensure_table(spark, layers.dim_customer, DIM_CUSTOMER, (), layers.root)
    ensure_table(spark, layers.dim_product, DIM_PRODUCT, (), layers.root)
    ensure_table(spark, layers.dim_date, DIM_DATE, (), layers.root)
    ensure_table(spark, layers.fact_sales_orders, FACT, (), layers.root)
    ensure_keys(spark, layers.fact_order_ids, ORDER_IDS, "order_id", layers.order_buckets, layers.root)
    ensure_table(spark, layers.sales_summary, SALES_SUMMARY, ["year", "month"], layers.root)
    ensure_table(spark, layers.sales_totals, SALES_TOTALS, [RUN], layers.root)
    ensure_table(spark, layers.dim_product_sales, PRODUCT_SALES, (), layers.root)


def setup_metrics(spark: SparkSession, layers: Layers) -> None:
    ensure_database(spark, layers.metrics, layers.root)
    ensure_table(spark, layers.dq_report, DQ_REPORT, (), layers.root)
    ensure_table(spark, layers.pipeline_run_log, RUN_LOG, (), layers.root)
    ensure_table(spark, layers.pipeline_steps, STEPS, (), layers.root)


def sql_text(value: str) -> str:
    """A value as it stands between the quotes of a SQL literal."""
    return value.replace("\\", "\\\\").replace("'", "\\'")


def partition_folder(spark: SparkSession, table: str, column: str, value: str) -> str | None:
    """Folder of one partition, from the catalog; None where there is no such partition."""
    found = spark.sql(f"SHOW PARTITIONS {table} PARTITION ({column} = '{sql_text(value)}')").first()
    return f"{table_path(spark, table)}/{found.partition}" if found else None


def partition_folders(spark: SparkSession, table: str, column: str) -> dict[str, str]:
    """Value → folder of the partitions of a table with one partition column."""
    root = table_path(spark, table)
    specs = [row.partition for row in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    return {unquote(spec.split("=", 1)[1]): f"{root}/{spec}" for spec in specs}


def partition_values(spark: SparkSession, table: str, column: str) -> list[str]:
    """Values of a partition column, from the catalog alone."""
    specs = (row.partition for row in spark.sql(f"SHOW PARTITIONS {table}").collect())
    pairs = (part.split("=", 1) for spec in specs for part in spec.split("/"))
    return sorted({unquote(value) for name, value in pairs if name == column})


def row_count(spark: SparkSession, table: str) -> int:
    """Rows of the whole table, over all runs."""
    return spark.table(table).count()


def _in_table_order(df: DataFrame, table: str) -> DataFrame:
    """Columns by name, in the order of the table; other columns raise."""
    names = df.sparkSession.table(table).columns
    unknown = {c.lower() for c in df.columns} - {c.lower() for c in names}
    if unknown:
        raise ValueError(f"{table} has no columns {sorted(unknown)}")
    return df.select(*names)


def append_table(df: DataFrame, table: str) -> None:
    _in_table_order(df, table).write.insertInto(table)


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _overwrite_mode(spark: SparkSession, mode: str):
    return _setting(spark, _OVERWRITE_MODE, mode)


def append_files(df: DataFrame, table: str) -> None:
    """Append rows to a partitioned table as they come from their files, neither shuffled nor sorted.

    A task keeps the files of some partitions open at a time; beyond them it sorts its rows.
    """
    with _setting(df.sparkSession, _OPEN_WRITERS, str(OPEN_FILES)):
        append_table(df, table)


def overwrite_table(df: DataFrame, table: str) -> None:
    """Replace the whole table; ``df`` must not read from it."""
    with _overwrite_mode(df.sparkSession, "static"):
        _in_table_order(df, table).write.insertInto(table, overwrite=True)


def overwrite_partitions(df: DataFrame, table: str) -> None:
    """Replace only the partitions that occur in ``df``, which may read from the table."""
    with _overwrite_mode(df.sparkSession, "dynamic"):
        _in_table_order(df, table).write.insertInto(table, overwrite=True)


# Size that clustered files are made for, and the size below which a file is not worth a core.
FILE_BYTES = 256 << 20
LEAST_BYTES = 4 << 20


def range_count(spark: SparkSession, stored_bytes: int, file_bytes: int = FILE_BYTES) -> int:
    """Ranges for rows that take ``stored_bytes``: files of the target size, or one a core.

    Small inputs are spread over the cores as long as the files keep ``LEAST_BYTES``.
    """
    cores = spark.sparkContext.defaultParallelism
    least = min(LEAST_BYTES, file_bytes)
    return max(1, math.ceil(stored_bytes / file_bytes), min(cores, math.ceil(stored_bytes / least)))


def plan_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` reads, as Spark's listing has them, for scans and unions."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


# A broadcast of rows that take so many times the session's limit still fits a small driver.
BROADCAST_ROOM = 5


def by_rows(stored: DataFrame, *columns: str) -> DataFrame:
    """A table or frozen result as the side of a join that uses ``columns``; never broadcast where it is large.

    Spark sizes it by its files, where sorted keys take a byte or two each, and would send
    millions of them through the driver. Here its rows are counted, from the file footers,
    and taken at the width of their types. The hint holds for what is made of the rows too.
    """
    spark = stored.sparkSession
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    # Eight bytes a row besides its columns, as the optimizer has it.
    width = 8 + (stored.select(*columns) if columns else stored)._jdf.schema().defaultSize()
    return stored.hint("merge") if limit >= 0 and stored.count() * width > BROADCAST_ROOM * limit else stored


def clustered(
    df: DataFrame,
    keys: Sequence[str],
    unique_key: str,
    partition_by: Sequence[str] = (),
    stored_bytes: int | None = None,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Range-partition and sort by the clustering keys, so files cover narrow key ranges.

    The unique key comes last in the ranges: a hot clustering value is spread over as many
    files as its size asks for. With ``stored_bytes``, what the rows take where they come
    from, the number of ranges follows ``file_bytes``; without, it is the session's.
    """
    order = [*partition_by, *keys]
    parts = [] if stored_bytes is None else [range_count(df.sparkSession, stored_bytes, file_bytes)]
    return df.repartitionByRange(*parts, *order, unique_key).sortWithinPartitions(*order)


def file_ranges(table: DataFrame, key: str, *by: str) -> DataFrame:
    """Rows and key range of every data file; files of rows without the key have NULL bounds."""
    files = table.groupBy(*by, F.col("_metadata.file_path").alias("file"))
    return files.agg(F.count(F.lit(1)).alias("n_rows"), F.min(key).alias("low"), F.max(key).alias("high"))


def with_order_month(df: DataFrame) -> DataFrame:
    """Layout column of ``stg_sales``; rows without a date go by the month of their ingest."""
    undated = F.concat_ws("-", F.lit(NO_MONTH), F.date_format("_ingested_at", "yyyy-MM"))
    return df.withColumn(MONTH, F.coalesce(F.date_format("order_date", "yyyy-MM"), undated))


def upsert_orders(
    batch: DataFrame, table: str, runs: str | Sequence[str] = (), bucket_rows: int | None = None
) -> None:
    """Put the orders of a batch into ``table``; of two versions the later ingest stays.

    The months of earlier versions come from the table of keys beside ``table``, so only the
    batch is shuffled to find them. Months that hold an earlier version are rewritten, rows
    of all other months are appended. ``runs`` are runs of which an earlier attempt may have
    left rows: the batch holds them in full, and what is there of them is replaced, also
    rows without an order id.
    """
    spark = batch.sparkSession
    runs = [runs] if isinstance(runs, str) else list(runs)
    index = f"{table}_keys"
    _rebuild_lost_index(spark, table, index)
    with frozen(with_order_month(batch), "upsert") as stored, frozen(known_months(stored, index), "known") as known:
        # Months are bounded by the calendar, so their names may come to the driver.
        months = {row[0] for row in known.select(MONTH).distinct().collect()}
        if runs:
            left_behind = spark.table(table).where(F.col(RUN).isin(runs)).select(MONTH)
            months |= {row[0] for row in left_behind.distinct().collect()}
        if months:
            _merge_months(stored, known, table, runs, sorted(months))
        else:
            _append_orders(stored, table)
        # An order that stays in its months is in the table of keys already.
        placed = stored.where("order_id IS NOT NULL").select("order_id", MONTH)
        if bucket_rows:
            # Orders that the table of keys does not hold at all; of the others few are new to their month.
            coming = stored.count() - known.count()
            grow_keys(spark, index, "order_id", bucket_rows, max(0, coming))
        append_keys(placed.join(by_rows(known), ["order_id", MONTH], "left_anti"), index, "order_id")
    if bucket_rows:
        grow_keys(spark, index, "order_id", bucket_rows)


def known_months(batch: DataFrame, index: str) -> DataFrame:
    """``order_id`` and month of the batch's orders that the table of keys holds.

    The batch is dealt into the buckets of the table, which stays where it is.
    """
    spark = batch.sparkSession
    ids = by_rows(batch, "order_id").where("order_id IS NOT NULL").select("order_id")
    return spark.table(index).join(ids.repartition(bucket_count(spark, index), "order_id"), "order_id", "left_semi")


def _rebuild_lost_index(spark: SparkSession, table: str, index: str) -> None:
    if spark.table(index).isEmpty():
        held = spark.table(table).where("order_id IS NOT NULL").select("order_id", MONTH)
        if not held.isEmpty():
            append_keys(held, index, "order_id")


CLUSTER = ["order_date", "region"]


def _append_orders(rows: DataFrame, table: str, places: DataFrame | None = None) -> None:
    if places is None:
        layout = clustered(rows, CLUSTER, "order_id", [MONTH], plan_bytes(rows))
    else:
        layout = _clustered_latest(rows, places)
    append_table(layout, table)


def _places(versions: DataFrame) -> DataFrame:
    """Where each version of an order lies, and its place among them; the first one stays."""
    newest = Window.partitionBy("order_id").orderBy(F.col("_ingested_at").desc_nulls_last(), F.col("_newer").desc())
    return versions.select(MONTH, *CLUSTER, "order_id", "_newer", F.row_number().over(newest).alias("_place"))


def _clustered_latest(rows: DataFrame, places: DataFrame) -> DataFrame:
    """``rows`` in the layout of ``clustered``, without the versions whose place is not the first.

    Rows and places of a version have the same clustering key, so they meet in the ranges
    that the files are made of; places sort before their rows.
    """
    order = [MONTH, *CLUSTER]
    parts = range_count(rows.sparkSession, plan_bytes(rows))
    both = rows.unionByName(places, allowMissingColumns=True)
    version = Window.partitionBy(*order, "order_id", "_newer")
    seen = version.orderBy(F.col("_place").asc_nulls_last(), F.col("_ingested_at").desc_nulls_last())
    seen = seen.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = both.repartitionByRange(parts, *order, "order_id").withColumns(
        {
            "_best": F.first("_place").over(seen),
            "_nth": F.count(F.lit(1)).over(seen) - F.count("_place").over(seen),
        }
    )
    kept = met.where("_place IS NULL AND (_best IS NULL OR (_best = 1 AND _nth = 1))")
    return kept.drop("_newer", "_place", "_best", "_nth").sortWithinPartitions(*order)


def _merge_months(batch: DataFrame, known: DataFrame, table: str, runs: list[str], months: list[str]) -> None:
    """Rewrite the given months, which hold all earlier versions; append what goes elsewhere.

    Which version of an order stays is found from a few columns; whole rows are shuffled once,
    into their files.
    """
    spark = batch.sparkSession
    of_runs = F.coalesce(F.col(RUN).isin(runs), F.lit(False)) if runs else F.lit(False)
    inside = F.col(MONTH).isin(months)
    held = spark.table(table).where(inside & ~of_runs).select(*batch.columns)
    again = by_rows(known, "order_id").select("order_id").distinct()
    rows = held.withColumn("_newer", F.lit(0)).unionByName(batch.withColumn("_newer", F.lit(1)))
    with frozen(_places(rows.join(again, "order_id", "left_semi")), "places") as places:
        lost = places.where("_place > 1").groupBy(MONTH).agg(F.count(F.lit(1)).alias("lost"))
        left = rows.where(inside).groupBy(MONTH).count().join(lost, MONTH, "left")
        kept = {row[0] for row in left.where("count > coalesce(lost, 0)").select(MONTH).collect()}
        if not batch.where(~inside).isEmpty():
            _append_orders(rows.where(~inside), table, places.where(~inside))
        overwrite_partitions(_clustered_latest(rows.where(inside), places.where(inside)), table)
    # Months that lost their last row do not occur in the result and must be dropped.
    for month in sorted(set(months) - kept):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({MONTH} = '{month}')")
        # The folder of a partition at a fixed location stays behind a dropped partition.
        remove_folder(spark, f"{table_path(spark, table)}/{MONTH}={month}")


def table_path(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").collect()
    return rows[0].data_type
