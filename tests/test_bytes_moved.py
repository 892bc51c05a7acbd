"""Steps of the job that must move no row twice where once is enough."""

import dataclasses
import re
from datetime import datetime

import pytest
from conftest import write_csv
from ordermart.plans.batch import run_full_pipeline
from ordermart.plans.keycounts import count_keys, refresh_key_counts
from ordermart.plans.models import refresh_stg_sales
from ordermart.operators.staging import stage_latest
from ordermart.plans import transformation
from ordermart.schemas import BUSINESS_COLUMNS
from ordermart.session import move_files
from ordermart.sinks import tables as sinks
from ordermart.sinks.tables import bucket_count, setup_staging, upsert_orders
from ordermart.sources.landing import read_landing
from pyspark.sql import functions as F
from test_scale_plans import NO_BROADCAST, plan_of, settings, shuffles, tables  # noqa: F401

from gate import spark_queries


@pytest.fixture
def rewritten(monkeypatch):
    """Rows of every rewrite of a table of keys."""
    seen, rewrite = [], sinks.rewrite_keys

    def counted(keys, table, *rest):
        seen.append((table.split(".")[1], keys.count()))
        return rewrite(keys, table, *rest)

    monkeypatch.setattr(sinks, "rewrite_keys", counted)
    return seen


def test_room_for_keys_is_made_before_they_are_appended(spark, layers, tmp_path, rewritten):
    layers = dataclasses.replace(layers, bucket_rows=10)
    run_full_pipeline(spark, write_csv(tmp_path / "a.csv", [{"order_id": f"O{i}"} for i in range(600)]), "RUN_1", layers)
    refresh_stg_sales(spark, datetime(2024, 3, 1), layers)
    refresh_key_counts(spark, layers)
    names = [name.split(".")[1] for name in (layers.fact_order_ids, layers.stg_sales_keys, layers.raw_key_counts)]
    assert rewritten == [(name, 0) for name in names]
    assert [bucket_count(spark, t) for t in (layers.fact_order_ids, layers.stg_sales_keys, layers.raw_key_counts)] == [64, 64, 128]
    assert spark.table(layers.fact_order_ids).distinct().count() == 600
    assert spark.table(layers.stg_sales_keys).distinct().count() == 600
    assert spark.table(layers.raw_key_counts).count() == 1200


def test_hex_keys_are_counted_as_bytes_and_all_keys_come_back(spark):
    keys = ["ab12", "ab12", "AB12", "abc", "0abc", "zz", "", "12", None]
    rows = spark.createDataFrame([(k, k, "d") for k in keys], "order_id string, _row_hash string, _delivery string")
    counts = count_keys(rows)
    plan = plan_of(counts)
    assert re.search(r"Exchange hashpartitioning\(name#\d+, digits#\d+, text#\d+", plan)
    found = sorted((r.name, r.key, r.delivery, r.n) for r in counts.collect())
    one = {k: keys.count(k) for k in keys if k is not None}
    assert found == sorted((name, k, "d", n) for name in ("order_id", "_row_hash") for k, n in one.items())


def test_totals_of_runs_are_not_added_up_before_the_summary(spark, tables, settings, monkeypatch):  # noqa: F811
    settings(**NO_BROADCAST)
    written = {}

    def keep(df, table):
        written[table] = plan_of(df)

    monkeypatch.setattr(transformation, "update_totals", lambda *_: [202401])
    monkeypatch.setattr(transformation, "overwrite_partitions", keep)
    transformation.refresh_sales_summary(spark, tables, "RUN_1")
    plan = written[tables.sales_summary]
    # Both sides of the joins with products and customers, the groups, and their months.
    assert sorted(shuffles(plan)) == ["hashpartitioning"] * 5 + ["rangepartitioning"]
    # The text is top-down: customers, with their two texts, come last.
    assert plan.index("[customer_sk#") < plan.index("[product_sk#")


def test_totals_of_a_run_are_shuffled_once(spark, tables, settings, monkeypatch):  # noqa: F811
    settings(**NO_BROADCAST)
    plans = []
    monkeypatch.setattr(transformation, "overwrite_partitions", lambda df, table: plans.append(plan_of(df)))
    transformation.update_totals(spark, "RUN_1", tables)
    below = plans[0][: plans[0].index("SortMergeJoin")]
    assert shuffles(below) == ["hashpartitioning"] and "Sort [" in below


def test_merging_months_shuffles_whole_rows_once(spark, layers, raw, settings, monkeypatch):  # noqa: F811
    settings(**NO_BROADCAST)
    setup_staging(spark, layers)
    days = ["2024-01-05", "2024-02-05", None]
    first = [{"order_id": f"O{i}", "order_date": days[i % 3], "_ingested_at": f"2024-02-0{1 + i % 4} 00:00:00"} for i in range(30)]
    again = [{**row, "order_date": days[i % 2], "_ingested_at": "2024-02-02 00:00:00", "status": "FAILED"} for i, row in enumerate(first[::2])]
    lone = [{"order_id": None, "order_date": days[0]}, {"order_id": "N", "order_date": "2024-03-01"}]
    upsert_orders(stage_latest(raw(*first, *lone[:1]), datetime(2024, 3, 1)), layers.stg_sales)
    plans, write = [], sinks.overwrite_partitions
    monkeypatch.setattr(sinks, "overwrite_partitions", lambda df, table: (plans.append(plan_of(df)), write(df, table)))
    upsert_orders(stage_latest(raw(*again, *lone), datetime(2024, 3, 1)), layers.stg_sales)
    # So few rows make a single range.
    assert [re.findall(r"Exchange (\w+)", plan) for plan in plans] == [["SinglePartition"]]
    found = sorted((r.order_id or "", str(r.order_date), r.status) for r in spark.table(layers.stg_sales).collect())
    wanted = {row["order_id"]: row for row in [*first, *lone[1:]]}
    # Of equal ingest times the batch's version stays.
    wanted |= {row["order_id"]: row for row in again if row["_ingested_at"] >= wanted[row["order_id"]]["_ingested_at"]}
    rows = [(k, str(v["order_date"]), v.get("status", "COMPLETED")) for k, v in wanted.items()]
    assert found == sorted([*rows, *[("", days[0], "COMPLETED")] * 2])


def test_a_repeated_row_leaves_one_version_in_a_merged_month(spark, layers, raw):
    setup_staging(spark, layers)
    upsert_orders(stage_latest(raw({"order_id": "A"}), datetime(2024, 3, 1)), layers.stg_sales)
    twice = stage_latest(raw({"order_id": "A", "status": "FAILED"}), datetime(2024, 3, 1))
    upsert_orders(twice.unionByName(twice), layers.stg_sales)
    assert [(r.order_id, r.status) for r in spark.table(layers.stg_sales).collect()] == [("A", "FAILED")]


def test_landing_folders_of_both_runs_come_from_one_pass(spark, tmp_path):
    rows = spark.createDataFrame(
        [tuple([f"O{i}"] + ["x"] * 15 + [run, plant]) for i, (run, plant) in enumerate([("RUN_A", "pl1"), ("RUN_A", None), ("RUN_B", "pl1"), ("RUN_C", "pl2")])],
        ", ".join(f"{name} string" for name in [*BUSINESS_COLUMNS, "_pipeline_run_id", "plant"]),
    )
    again = (F.col("_pipeline_run_id") == "RUN_A") & (F.col("plant") == "pl1")
    runs = F.when(again, F.array(F.lit("RUN_A"), F.lit("RUN_B"))).otherwise(F.array("_pipeline_run_id"))
    folders = spark_queries._land_runs(rows, str(tmp_path), runs)
    landed = {run: sorted(r.order_id for r in read_landing(spark, folder).collect()) for run, folder in folders.items()}
    assert landed == {"RUN_A": ["O0", "O1"], "RUN_B": ["O0", "O2"]}
    for run, folder in folders.items():
        move_files(spark, folder, f"{tmp_path}/all", f"{run}-")
    assert sorted(r.order_id for r in read_landing(spark, f"{tmp_path}/all").collect()) == ["O0", "O0", "O1", "O2"]
