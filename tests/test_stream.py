import re

from conftest import write_csv
from pyspark.sql import functions as F

from ordermart.sources.landing import read_landing
from ordermart.streaming.landing import load_batch, run_landing_stream


def run(spark, tmp_path, layers, **options):
    run_landing_stream(spark, str(tmp_path / "in"), str(tmp_path / "progress"), layers, **options)


def state(spark, layers):
    """Status and run of every order; the id of the stream is left out of the run."""
    rows = spark.table(layers.stg_sales).collect()
    return {r.order_id: (r.status, re.sub("_[0-9a-f]{32}_", "_", r._pipeline_run_id)) for r in rows}


def test_only_new_files_are_loaded_and_later_versions_win(spark, layers, tmp_path):
    write_csv(tmp_path / "in" / "a.csv", [{"order_id": "A", "status": "PENDING"}, {"order_id": "B"}])
    run(spark, tmp_path, layers)
    assert state(spark, layers) == {"A": ("PENDING", "landing_000000"), "B": ("COMPLETED", "landing_000000")}
    run(spark, tmp_path, layers)
    assert spark.table(layers.raw_sales_orders).count() == 2
    write_csv(tmp_path / "in" / "b.csv", [{"order_id": "A", "status": "FAILED"}, {"order_id": "C"}])
    run(spark, tmp_path, layers)
    assert spark.table(layers.raw_sales_orders).count() == 4
    assert state(spark, layers) == {
        "A": ("FAILED", "landing_000001"),
        "B": ("COMPLETED", "landing_000000"),
        "C": ("COMPLETED", "landing_000001"),
    }
    files = {r._source_file for r in spark.table(layers.raw_sales_orders).collect()}
    assert files == {"a.csv", "b.csv"}


def test_several_batches_in_one_second_lose_nothing(spark, layers, tmp_path):
    for name in "abc":
        write_csv(tmp_path / "in" / f"{name}.csv", [{"order_id": name}, {"order_id": None}])
    run(spark, tmp_path, layers, max_files=1)
    table = spark.table(layers.stg_sales)
    assert sorted(r.order_id for r in table.where("order_id IS NOT NULL").collect()) == ["a", "b", "c"]
    assert table.where("order_id IS NULL").count() == 3


def test_repeated_batch_changes_nothing(spark, layers, tmp_path):
    path = write_csv(tmp_path / "in" / "a.csv", [{"order_id": "A"}, {"order_id": None}])
    run(spark, tmp_path, layers)
    batch = read_landing(spark, path).withColumn("_source_file", F.lit("a.csv"))
    load_batch(batch, spark.table(layers.stg_sales).first()._pipeline_run_id, layers)
    assert spark.table(layers.raw_sales_orders).count() == 2
    assert spark.table(layers.stg_sales).count() == 2


def test_two_checkpoints_and_a_renewed_one_keep_all_rows(spark, layers, tmp_path):
    write_csv(tmp_path / "x" / "a.csv", [{"order_id": "X1"}, {"order_id": "X2"}])
    write_csv(tmp_path / "y" / "a.csv", [{"order_id": "Y1"}])
    for folder in "xy":
        run_landing_stream(spark, str(tmp_path / folder), str(tmp_path / f"progress-{folder}"), layers)
    assert sorted(state(spark, layers)) == ["X1", "X2", "Y1"]
    assert spark.table(layers.raw_sales_orders).count() == 3
    run_landing_stream(spark, str(tmp_path / "x"), str(tmp_path / "renewed"), layers)
    assert sorted(state(spark, layers)) == ["X1", "X2", "Y1"]
    raw = spark.table(layers.raw_sales_orders)
    assert raw.count() == 5 and raw.select("_pipeline_run_id").distinct().count() == 3


def test_line_breaks_in_quotes(spark, layers, tmp_path):
    write_csv(tmp_path / "in" / "a.csv", [{"order_id": "N1", "customer_name": "two\nlines, \"quoted\""}])
    run(spark, tmp_path, layers, multi_line=True)
    assert spark.table(layers.raw_sales_orders).first().customer_name == 'two\nlines, "quoted"'
