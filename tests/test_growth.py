"""What must grow no faster than the input: shuffled and written bytes, and what one task reads."""

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_closing import LATER, RUN, land, rows  # noqa: F401
from test_scale_plans import NO_BROADCAST, plan_of, settings  # noqa: F401

from gate import inputs, spark_queries
from ordermart.operators.staging import stage_runs
from ordermart.plans import closing
from ordermart.plans.closing import close_runs
from ordermart.schemas import closed_part
from ordermart.session import freeze
from ordermart.sinks.tables import setup_raw

KEYS = {
    "lineitem": "SELECT id AS l_orderkey, id % 7 AS l_partkey, id % 5 AS l_suppkey, 1 + id % 7 AS l_linenumber, "
    "CAST(id AS DOUBLE) AS l_quantity, 'A' AS l_returnflag, TIMESTAMP_NTZ '1995-01-01' AS l_shipdate FROM range(300)",
    # Some orders twice, some without a customer.
    "orders": "SELECT id % 250 AS o_orderkey, IF(id % 9 = 0, NULL, id % 20) AS o_custkey, "
    "TIMESTAMP_NTZ '1995-01-02' AS o_orderdate, 'F' AS o_orderstatus FROM range(280)",
    "customer": "SELECT id % 18 AS c_custkey, 'C' || id AS c_name, 'BUILDING' AS c_mktsegment, "
    "IF(id = 3, NULL, id % 3) AS c_nationkey FROM range(20)",
    "part": "SELECT id AS p_partkey, 'P' || id AS p_name, 'TIN' AS p_type, 10.5D AS p_retailprice FROM range(6)",
    "nation": "SELECT id AS n_nationkey, id % 2 AS n_regionkey FROM range(3)",
    "region": "SELECT id AS r_regionkey, 'ASIA' AS r_name FROM range(2)",
}


@pytest.fixture
def given(spark, tmp_path):
    for name, sql in KEYS.items():
        spark.sql(sql).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_raw_orders_are_those_of_the_sql(spark, given):
    tables = {name: spark.read.parquet(f"{given}/{name}.parquet") for name in inputs.TABLES}
    wanted = spark.sql(inputs.BASE_SQL, **tables)
    found = inputs.raw_base(spark, given)
    assert found.columns == wanted.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect())) != []


def test_lines_are_shuffled_for_orders_and_parts_only(spark, given, settings):  # noqa: F811
    settings(**NO_BROADCAST)
    plan = plan_of(inputs.raw_base(spark, given))
    # Customers meet the orders below the join with the lines, not above it.
    assert plan.index("Exchange hashpartitioning(l_orderkey") < plan.index("Exchange hashpartitioning(o_custkey")


def test_lines_are_dealt_into_parts_that_grow(spark, given, monkeypatch):
    monkeypatch.setattr(inputs, "DEAL_BYTES", 20)
    dealt = [text for text in plan_of(inputs.raw_base(spark, given)).split("\n") if "REPARTITION_BY_NUM" in text]
    assert int(dealt[0].split("l_orderkey#")[1].split("), REPARTITION")[0].split(", ")[1]) > 8


def test_landing_files_are_bounded_and_compressed(spark, orders, tmp_path, monkeypatch):
    monkeypatch.setattr(spark_queries, "LANDING_ROWS", 10)
    path = f"{tmp_path}/landing"
    spark_queries._write_landing(orders(*[{"order_id": f"O{i}"} for i in range(45)]).coalesce(1), path)
    assert len(list(Path(path).glob("*.csv.gz"))) == 5
    back = spark_queries.read_landing(spark, path, multi_line=True)
    assert sorted(r.order_id for r in back.collect()) == sorted(f"O{i}" for i in range(45))


def test_stored_rows_take_zstd(spark, layers, land):  # noqa: F811
    land("R1", "O1", "O2")
    stored = spark.table(layers.raw_sales_orders)
    frozen = freeze(stored, "raw")
    for df in (stored, frozen):
        assert all(name.endswith(".zstd.parquet") for name in df.inputFiles()) and df.count() == 2


def test_row_hash_is_shuffled_as_bytes(spark, raw):
    df = raw(*[{"order_id": "O1", "plant_code": f"P{i}"} for i in range(40)])
    staged = stage_runs(df, datetime(2024, 3, 1))
    assert "unhex" in plan_of(staged)
    smallest = min(df.collect(), key=lambda r: r._row_hash)
    assert [r.plant_code for r in staged.collect()] == [smallest.plant_code]


def test_hash_that_is_no_hex_settles_ties_too(spark, raw):
    df = raw(*[{"order_id": "O1", "plant_code": p} for p in ("A", "B")])
    df = df.withColumn("_row_hash", F.when(F.col("plant_code") == "A", "zz").otherwise("xx"))
    assert [r.plant_code for r in stage_runs(df, datetime(2024, 3, 1)).collect()] == ["B"]


@pytest.mark.parametrize("least,kept", [(0, True), (1 << 40, False)])
def test_large_closing_leaves_the_files_of_its_day(spark, layers, land, rows, monkeypatch, least, kept):  # noqa: F811
    monkeypatch.setattr(closing, "APPEND_BYTES", least)
    setup_raw(spark, layers)
    table = layers.raw_sales_orders
    land("R1", "O1", "O2")
    close_runs(spark, LATER, layers)
    before = set(spark.table(closed_part(table)).inputFiles())
    land("R2", "O2", "O3")
    close_runs(spark, LATER, layers)
    spark.catalog.refreshTable(closed_part(table))
    assert (before <= set(spark.table(closed_part(table)).inputFiles())) == kept
    assert rows(table) == [("R1", "O1"), ("R1", "O2"), ("R2", "O2"), ("R2", "O3")]
    assert rows(table, ["R2"]) == [("R2", "O2"), ("R2", "O3")] and spark.table(table).count() == 0
    assert RUN in spark.table(closed_part(table)).columns


def test_large_closing_that_stops_is_put_right(spark, layers, land, rows, monkeypatch):  # noqa: F811
    monkeypatch.setattr(closing, "APPEND_BYTES", 0)
    land("R1", "O1", "O2")

    def stop(entries, table, status, record=closing._record):
        if status == closing.LOADED:
            raise RuntimeError("stopped")
        record(entries, table, status)

    with monkeypatch.context() as patched:
        patched.setattr(closing, "_record", stop)
        with pytest.raises(RuntimeError, match="stopped"):
            close_runs(spark, LATER, layers)
    close_runs(spark, LATER, layers)
    assert rows(layers.raw_sales_orders) == [("R1", "O1"), ("R1", "O2")]
