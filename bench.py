"""Headline timings over the given tables; prints one JSON line.

    BENCH_SF_DIR   folder of tables      (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores           (default 4)
    BENCH_RUNS     timed runs of a query from the given tables, after one warm-up (default 1)
    BENCH_REPEATS  timed runs of a step on the loaded tables, after one warm-up (default 3)
    BENCH_ONLY     comma-separated query names
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from gate.inputs import raw_orders  # noqa: E402
from gate.spark_queries import AT, QUERIES, RUNS, SPLIT  # noqa: E402
from ordermart.operators.facts import fact_rows  # noqa: E402
from ordermart.operators.marts import sales_summary  # noqa: E402
from ordermart.operators.quality import run_checks  # noqa: E402
from ordermart.operators.staging import stage_latest, stage_runs  # noqa: E402
from ordermart.plans.models import refresh_stg_sales  # noqa: E402
from ordermart.plans.transformation import run_transformations  # noqa: E402
from ordermart.schemas import FACT, Layers  # noqa: E402
from ordermart.session import build_session  # noqa: E402
from ordermart.sinks.tables import append_table, setup_raw  # noqa: E402

# Registered queries timed end to end, from the given tables.
HEADLINE = [
    "natural_summary",
    "staging_strict",
    "staging_lenient",
    "row_hash",
    "dq_report",
    "dim_merge_insert_only",
    "fact_orders",
    "sales_summary",
    "csv_roundtrip",
]


def consume(df: DataFrame) -> None:
    """Compute every column of every row without storing them."""
    df.write.format("noop").mode("overwrite").save()


def median_seconds(work: Callable[[], None], runs: int) -> float:
    work()
    times = []
    for _ in range(runs):
        started = time.perf_counter()
        work()
        times.append(time.perf_counter() - started)
    return round(statistics.median(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    only = os.environ.get("BENCH_ONLY")
    work_dir = tempfile.mkdtemp(prefix="ordermart-bench-")
    settings = {
        "spark.master": f"local[{cpus}]",
        "spark.driver.memory": "8g",
        "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.warehouse.dir": f"{work_dir}/warehouse",
        "spark.checkpoint.dir": f"{work_dir}/checkpoints",
    }
    spark = build_session("ordermart-bench", **{k.replace(".", "__"): v for k, v in settings.items()})
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name: str, work: Callable[[], None], repeat: int = repeats) -> None:
        if only is None or name in only.split(","):
            seconds[name] = median_seconds(work, repeat)
            print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)

    for name in HEADLINE:
        timed(name, lambda name=name: consume(QUERIES[name](spark, sf_dir)), runs)

    # The tables of the job, loaded once, for the incremental and layout measures.
    layers = Layers(root=f"{work_dir}/tables")
    setup_raw(spark, layers)
    started = time.perf_counter()
    append_table(raw_orders(spark, sf_dir), layers.raw_sales_orders)
    seconds["load_raw"] = round(time.perf_counter() - started, 3)
    started = time.perf_counter()
    for run_id in RUNS:
        run_transformations(spark, run_id, AT, layers)
    seconds["transform_both_runs"] = round(time.perf_counter() - started, 3)
    raw = spark.table(layers.raw_sales_orders)
    staged = spark.table(layers.stg_sales_orders)
    fact = spark.table(layers.fact_sales_orders)
    dims = [spark.table(t) for t in (layers.dim_date, layers.dim_customer, layers.dim_product)]
    empty_fact = spark.createDataFrame([], FACT)

    timed("stage_one_run", lambda: consume(stage_runs(raw, AT, RUNS[1])))
    timed("stage_all_runs", lambda: consume(stage_runs(raw, AT)))
    timed("checks_on_raw_table", lambda: run_checks(raw, "ALL").collect())
    timed("fact_load_into_empty", lambda: consume(fact_rows(staged, empty_fact, *dims[1:], RUNS[1], AT)))
    timed("fact_load_into_full", lambda: consume(fact_rows(staged, fact, *dims[1:], RUNS[1], AT)))
    timed("summary_from_star", lambda: consume(sales_summary(fact, *dims)))
    timed("summary_from_stored_table", lambda: consume(spark.table(layers.sales_summary)))

    started = time.perf_counter()
    refresh_stg_sales(spark, AT, layers)
    seconds["stg_sales_first_load"] = round(time.perf_counter() - started, 3)
    late = raw.where(F.col("_ingested_at") > F.lit(SPLIT).cast("timestamp_ntz"))
    timed("stage_newer_than_watermark", lambda: consume(stage_latest(late, AT)))

    # The same rows, sorted by the clustering keys and as they come.
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    scattered = f"{work_dir}/scattered"
    fact.repartition(16).write.option("parquet.block.size", 1 << 20).parquet(scattered)
    ordered = f"{work_dir}/ordered"
    fact.repartitionByRange(16, "date_key", "status", "order_id").sortWithinPartitions(
        "date_key", "status"
    ).write.option("parquet.block.size", 1 << 20).parquet(ordered)
    month = "date_key BETWEEN 19950301 AND 19950331"
    timed("date_range_on_unsorted", lambda: consume(spark.read.parquet(scattered).where(month)))
    timed("date_range_on_sorted", lambda: consume(spark.read.parquet(ordered).where(month)))

    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
                "config": settings,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
