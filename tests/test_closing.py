"""Runs that are over, merged by day: same rows, few folders, still replaceable."""

from datetime import datetime, timedelta

import pytest
from conftest import write_csv
from ordermart.plans import closing
from ordermart.plans.closing import close_runs, finish_closing, rows_by_run, run_bytes
from ordermart.plans.deliveries import pending_deliveries, raw_deliveries
from ordermart.plans.ingestion import load_raw, prepare, run_ingestion
from ordermart.plans.models import count_failures, refresh_product_sales, refresh_stg_sales
from ordermart.plans.transformation import run_transformations
from ordermart.schemas import closed_part, closed_runs
from ordermart.sinks.tables import append_table, partition_values, setup_raw, setup_staging
from ordermart.streaming.landing import load_batch

AT = datetime(2024, 3, 1)
LATER = datetime(2030, 1, 1)
RUN = "_pipeline_run_id"


@pytest.fixture
def land(spark, layers, tmp_path):
    count = iter(range(100))

    def deliver(run_id, *order_ids, day=0, **more):
        setup_raw(spark, layers)
        path = write_csv(tmp_path / f"{next(count)}.csv", [{"order_id": i, **more} for i in order_ids])
        load_raw(prepare(spark, path, run_id, AT + timedelta(days=day)), layers)

    return deliver


@pytest.fixture
def rows(spark, layers):
    def of(table, runs=None):
        return sorted((r[RUN], r.order_id) for r in rows_by_run(spark, table, runs).collect())

    return of


def folders(spark, table):
    return partition_values(spark, table, RUN), partition_values(spark, closed_part(table), "_closed_day")


def test_many_runs_end_in_a_folder_for_each_day(spark, layers, raw, rows):
    setup_raw(spark, layers)
    runs = [{"order_id": f"O{i}", RUN: f"R {i}'%", "_ingested_at": f"2024-02-0{1 + i % 3} 00:00:00"} for i in range(60)]
    append_table(raw(*runs).repartition(1), layers.raw_sales_orders)
    before = rows(layers.raw_sales_orders)
    ledger = sorted(map(tuple, raw_deliveries(spark, layers).select(RUN, "delivery").collect()))
    moved = close_runs(spark, datetime(2024, 2, 3), layers)
    assert len(moved["raw_sales_orders"]) == 40 and moved["stg_sales_orders"] == []
    left, days = folders(spark, layers.raw_sales_orders)
    assert len(left) == 20 and days == ["2024-02-01", "2024-02-02"]
    close_runs(spark, LATER, layers)
    assert folders(spark, layers.raw_sales_orders) == ([], ["2024-02-01", "2024-02-02", "2024-02-03"])
    assert rows(layers.raw_sales_orders) == before and len(before) == 60
    assert rows(layers.raw_sales_orders, ["R 7'%"]) == [("R 7'%", "O7")]
    assert sorted(map(tuple, raw_deliveries(spark, layers).select(RUN, "delivery").collect())) == ledger
    assert run_bytes(spark, layers.raw_sales_orders, "R 7'%") > 0
    assert close_runs(spark, LATER, layers) == {"raw_sales_orders": [], "stg_sales_orders": []}


def test_blocks_of_runs_share_a_day(spark, layers, raw, rows, monkeypatch):
    monkeypatch.setattr(closing, "BLOCK", 2)
    setup_raw(spark, layers)
    append_table(raw(*[{"order_id": f"O{i}", RUN: f"R{i}"} for i in range(5)]), layers.raw_sales_orders)
    close_runs(spark, LATER, layers)
    assert folders(spark, layers.raw_sales_orders) == ([], ["2024-02-01"])
    assert len(rows(layers.raw_sales_orders)) == 5


def test_only_days_of_the_runs_are_read(spark, layers, land):
    land("RUN_A", "O1")
    land("RUN_B", "O2", day=1)
    close_runs(spark, LATER, layers)
    files = rows_by_run(spark, layers.raw_sales_orders, ["RUN_B"]).inputFiles()
    assert files and all("_closed_day=2024-03-02" in f for f in files)
    land("RUN_C", "O3")
    assert all("RUN_C" in f for f in rows_by_run(spark, layers.raw_sales_orders, ["RUN_C"]).inputFiles())


def test_deliveries_of_closed_runs_are_loaded_once(spark, layers, land, rows):
    land("RUN_A", "O1")
    land("RUN_B", "O2", day=1)
    close_runs(spark, LATER, layers)
    assert refresh_stg_sales(spark, AT, layers) == ["RUN_A", "RUN_B"]
    land("RUN_A", "O3", "O1", day=2, status="FAILED")
    pending = pending_deliveries(spark, layers)
    assert len(pending.deliveries) == 1 and pending.replaced == [] and pending.whole == []
    assert refresh_stg_sales(spark, AT, layers) == ["RUN_A"]
    close_runs(spark, LATER, layers)
    assert refresh_stg_sales(spark, AT, layers) == []
    stored = sorted((r.order_id, r.status) for r in spark.table(layers.stg_sales).collect())
    assert stored == [("O1", "FAILED"), ("O2", "COMPLETED"), ("O3", "FAILED")]
    assert rows(layers.raw_sales_orders) == [("RUN_A", "O1"), ("RUN_A", "O1"), ("RUN_A", "O3"), ("RUN_B", "O2")]
    assert partition_values(spark, closed_part(layers.raw_sales_orders), "_closed_day") == [
        "2024-03-01",
        "2024-03-02",
        "2024-03-03",
    ]


def test_a_closed_run_is_staged_again_in_place(spark, layers, land, rows):
    land("RUN_A", "O1")
    land("RUN_B", "O2")
    for run in ("RUN_A", "RUN_B"):
        run_transformations(spark, run, AT, layers)
    close_runs(spark, LATER, layers)
    assert folders(spark, layers.stg_sales_orders) == ([], ["2024-03-01"])
    fact = spark.table(layers.fact_sales_orders).count()
    land("RUN_A", "O3")
    run_transformations(spark, "RUN_A", AT, layers)
    assert rows(layers.stg_sales_orders) == [("RUN_A", "O1"), ("RUN_A", "O3"), ("RUN_B", "O2")]
    assert spark.table(layers.fact_sales_orders).count() == fact + 1
    assert folders(spark, layers.stg_sales_orders) == (["RUN_A"], ["2024-03-01"])
    run_transformations(spark, "RUN_B", AT, layers)
    # The last run has left its day.
    assert folders(spark, layers.stg_sales_orders) == (["RUN_A", "RUN_B"], [])
    assert len(rows(layers.stg_sales_orders)) == 3


@pytest.mark.parametrize("state", ["LOADED", "CLOSED"])
def test_a_closing_that_stopped_is_put_right(spark, layers, land, rows, monkeypatch, state):
    """It stops behind the copy, or behind the removal of the originals."""
    land("RUN_A", "O1")
    land("RUN_B", "O2")
    record = closing._record

    def stop(entries, table, status):
        if status == state:
            raise OSError("stopped")
        record(entries, table, status)

    monkeypatch.setattr(closing, "_record", stop)
    with pytest.raises(OSError):
        close_runs(spark, LATER, layers)
    monkeypatch.undo()
    finish_closing(spark, layers)
    expected = [("RUN_A", "O1"), ("RUN_B", "O2")]
    assert rows(layers.raw_sales_orders) == expected
    assert folders(spark, layers.raw_sales_orders)[0] == (["RUN_A", "RUN_B"] if state == "LOADED" else [])
    close_runs(spark, LATER, layers)
    assert rows(layers.raw_sales_orders) == expected and folders(spark, layers.raw_sales_orders)[0] == []


def test_files_that_came_after_a_stopped_closing_stay(spark, layers, land, rows, monkeypatch):
    land("RUN_A", "O1")

    def stop(*_):
        raise OSError("stopped")

    monkeypatch.setattr(closing, "_drop_originals", stop)
    with pytest.raises(OSError):
        close_runs(spark, LATER, layers)
    monkeypatch.undo()
    land("RUN_A", "O2")
    finish_closing(spark, layers)
    assert rows(layers.raw_sales_orders) == [("RUN_A", "O1"), ("RUN_A", "O2")]


def test_a_repeated_batch_replaces_its_closed_rows(spark, layers, orders, rows):
    setup_raw(spark, layers)
    setup_staging(spark, layers)
    from pyspark.sql import functions as F

    batch = orders({"order_id": "O1"}, {"order_id": None}).withColumn("_source_file", F.lit("a.csv"))
    load_batch(batch, "s_0", layers)
    close_runs(spark, LATER, layers)
    load_batch(batch, "s_0", layers)
    assert len(rows_by_run(spark, layers.raw_sales_orders).collect()) == 2
    assert spark.table(layers.stg_sales).count() == 2


def test_checks_and_counts_cover_closed_runs(spark, layers, land, tmp_path):
    land("RUN_A", "O1", None)
    run_transformations(spark, "RUN_A", AT, layers)
    refresh_stg_sales(spark, AT, layers)
    refresh_product_sales(spark, layers)
    before = count_failures(spark, layers)
    assert before["raw_sales_orders.order_id not_null"] == 1
    close_runs(spark, LATER, layers)
    assert count_failures(spark, layers) == before
    path = write_csv(tmp_path / "more.csv", [{"order_id": "O1"}])
    assert run_ingestion(spark, path, "RUN_B", layers)["raw_table_rows"] == 3
    assert count_failures(spark, layers)["raw_sales_orders.order_id unique"] == 1
    assert spark.table(closed_runs(layers.raw_sales_orders)).where("status = 'CLOSED'").count() == 1
