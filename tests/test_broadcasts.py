"""Join sides that are small as files and large as rows are not sent through the driver."""

import re
from datetime import date, datetime

import pytest
from ordermart.operators.dimensions import new_members
from ordermart.operators.facts import with_dimension_keys
from ordermart.operators.marts import summary_of_totals
from ordermart.plans import models, transformation
from ordermart.sinks import tables as sinks
from ordermart.sinks.tables import append_table, by_rows
from ordermart.schemas import DIM_CUSTOMER, DIM_PRODUCT, FACT
from pyspark.sql import functions as F
from test_scale_plans import plan_of, settings, tables  # noqa: F401

AT = datetime(2024, 3, 1)


@pytest.fixture
def large_dimensions(spark, tables, settings):  # noqa: F811
    """60,000 members each, at least 1 MB as keys and less than 150 KB in the files."""
    settings(spark__sql__autoBroadcastJoinThreshold="150k")
    ids = spark.range(1, 60001, 1, 1)
    for table, schema, sk in ((tables.dim_customer, DIM_CUSTOMER, "customer_sk"), (tables.dim_product, DIM_PRODUCT, "product_sk")):
        texts = {"customer_id": "CUST-", "product_id": "PROD-"}
        columns = []
        for field in schema:
            value = F.lit("text")
            if field.name == sk:
                value = F.col("id")
            elif field.name in texts:
                value = F.concat(F.lit(texts[field.name]), "id")
            elif field.name == "_effective_from":
                value = F.lit(date(2024, 1, 1))
            elif field.name == "_is_current":
                value = F.lit(True)
            columns.append(value.alias(field.name))
        append_table(ids.select(*columns), table)
    return tables


def test_rows_not_files_say_what_is_broadcast(spark, large_dimensions, settings):  # noqa: F811
    held = spark.table(large_dimensions.dim_customer)
    batch = spark.createDataFrame([("CUST-1", "PROD-1")], "customer_id string, product_id string")
    plain = batch.join(held.select("customer_id"), "customer_id", "left_anti")
    assert "BroadcastHashJoin" in plan_of(plain)
    sized = batch.join(by_rows(held, "customer_id").select("customer_id"), "customer_id", "left_anti")
    assert "BroadcastHashJoin" not in plan_of(sized) and sized.count() == 0
    few = batch.join(by_rows(held.limit(10), "customer_id"), "customer_id", "left")
    assert "BroadcastHashJoin" in plan_of(few)
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    assert by_rows(held, "customer_id") is held


def test_steps_of_a_run_do_not_broadcast_large_dimensions(spark, large_dimensions, monkeypatch):
    layers, seen = large_dimensions, {}

    def new_rows(staging, dimension, key, attributes, *_):
        seen[key] = plan_of(new_members(staging, dimension, key, attributes))
        return dimension.limit(0)

    def keyed(staging, fact, dim_customer, dim_product, *_):
        orders = spark.table(layers.stg_sales_orders).select("customer_id", "product_id", "order_id")
        seen["fact"] = plan_of(with_dimension_keys(orders, dim_customer, dim_product))
        return spark.createDataFrame([], FACT)

    monkeypatch.setattr(transformation, "dimension_rows", new_rows)
    monkeypatch.setattr(transformation, "fact_rows", keyed)
    monkeypatch.setattr(transformation, "update_totals", lambda *_: [202401])
    monkeypatch.setattr(transformation, "overwrite_partitions", lambda df, _: seen.update(summary=plan_of(df)))
    for definition, table in ((transformation.CUSTOMER, layers.dim_customer), (transformation.PRODUCT, layers.dim_product)):
        transformation.load_dimension(spark, definition, table, AT, layers)
    transformation.load_fact(spark, "R1", AT, layers)
    transformation.refresh_sales_summary(spark, layers, "R1")
    assert set(seen) == {"customer_id", "product_id", "fact", "summary"}
    for name, plan in seen.items():
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan, name


def test_references_of_the_fact_do_not_broadcast_large_dimensions(spark, large_dimensions, monkeypatch):
    monkeypatch.setattr(models, "refresh_key_counts", lambda *_: [])
    failing = models.declared_tests(spark, large_dimensions)
    for key, table in (("customer_sk", "dim_customer"), ("product_sk", "dim_product")):
        plan = plan_of(failing[f"fact_sales_orders.{key} references {table}"])
        assert re.search(rf"SortMergeJoin \[{key}#\d+L?\], \[{key}#\d+L?\], LeftAnti", plan), plan
