"""Dirty raw orders derived from the given tables, as one SQL text for Spark and DuckDB."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.operators.ingest import with_row_hash
from ordermart.sinks.tables import plan_bytes

TABLES = ["lineitem", "orders", "customer", "part", "nation", "region"]
LINE_COLUMNS = "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_returnflag l_shipdate".split()

BASE_COLUMNS = """\
  CASE WHEN l.l_orderkey % 211 = 0 THEN NULL ELSE 'ORD-' || CAST(l.l_orderkey AS STRING) || '-' || CAST(l.l_linenumber AS STRING) END AS order_id,
  CASE WHEN l.l_orderkey % 97 = 0 THEN 'bad_date' ELSE CAST(CAST(o.o_orderdate AS DATE) AS STRING) END AS order_date,
  CASE WHEN o.o_custkey % 53 = 0 THEN NULL WHEN o.o_custkey % 53 = 1 THEN '  ' ELSE 'CUST-' || CAST(o.o_custkey AS STRING) END AS customer_id,
  ' ' || upper(c.c_name) || ' ' || lower(CASE WHEN o.o_custkey % 31 = 0 AND l.l_linenumber = 7 THEN 'LEGACY' ELSE c.c_mktsegment END) || ' ' AS customer_name,
  'PROD-' || CAST(l.l_partkey AS STRING) AS product_id,
  ' ' || p.p_name || ' ' AS product_name,
  lower(p.p_type) || ' ' AS category,
  CASE WHEN l.l_partkey % 101 = 0 THEN '0' WHEN l.l_partkey % 101 = 1 THEN 'ten' ELSE CAST(CAST(l.l_quantity AS INT) AS STRING) END AS quantity,
  CASE WHEN l.l_suppkey % 50 = 0 THEN '-10.00' WHEN l.l_suppkey % 50 = 1 THEN NULL ELSE CAST(CAST(p.p_retailprice AS DECIMAL(18,2)) AS STRING) END AS unit_price,
  CASE WHEN l.l_orderkey % 71 = 0 THEN '1.00' ELSE CAST(CAST(CAST(l.l_quantity AS DECIMAL(10,0)) * CAST(p.p_retailprice AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS STRING) END AS total_amount,
  CASE WHEN l.l_orderkey % 89 = 0 THEN 'XYZ' WHEN l.l_returnflag = 'A' THEN 'eur' WHEN l.l_returnflag = 'N' THEN 'USD' ELSE ' GBP' END AS currency,
  lower(r.r_name) AS region,
  'pl' || CAST(l.l_suppkey % 10 AS STRING) AS plant_code,
  'zor ' AS sap_document_type,
  'SYSTEM' AS created_by,
  CASE WHEN l.l_orderkey % 83 = 0 THEN 'INVALID_STATUS' WHEN l.l_orderkey % 83 = 1 THEN NULL WHEN o.o_orderstatus = 'F' THEN 'completed' WHEN o.o_orderstatus = 'O' THEN 'PENDING' ELSE ' cancelled' END AS status,
  CASE WHEN l.l_linenumber <= 4 THEN 'RUN_A' ELSE 'RUN_B' END AS _pipeline_run_id,
  l.l_shipdate AS _ingested_at,
  'lineitem.parquet' AS _source_file"""

BASE_SQL = f"""
SELECT
{BASE_COLUMNS}
FROM {{lineitem}} l
JOIN {{orders}} o ON l.l_orderkey = o.o_orderkey
JOIN {{customer}} c ON o.o_custkey = c.c_custkey
JOIN {{part}} p ON l.l_partkey = p.p_partkey
JOIN {{nation}} n ON c.c_nationkey = n.n_nationkey
JOIN {{region}} r ON n.n_regionkey = r.r_regionkey
"""


# Bytes of line columns dealt to one task: some million rows, which sort in memory.
DEAL_BYTES = 8 << 20


def raw_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 16 business columns with run id, ingest time and source file.

    The joins of ``BASE_SQL`` in another order: customers meet the orders before the lines,
    which are four times as many. Parts come first and orders last, so that the lines of an
    order leave side by side and their texts compress; the lines meet the orders in parts
    that grow with them.
    """
    tables = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in TABLES}
    lines = tables["lineitem"].select(*LINE_COLUMNS)
    parts = max(spark.sparkContext.defaultParallelism, math.ceil(plan_bytes(lines) / DEAL_BYTES))
    orders = (
        tables["orders"].alias("o")
        .join(tables["customer"].alias("c"), F.expr("o.o_custkey = c.c_custkey"))
        .join(tables["nation"].alias("n"), F.expr("c.c_nationkey = n.n_nationkey"))
        .join(tables["region"].alias("r"), F.expr("n.n_regionkey = r.r_regionkey"))
    )
    products = lines.alias("l").join(tables["part"].alias("p"), F.expr("l.l_partkey = p.p_partkey"))
    # A file of one row group would leave the rest of the derivation to one task.
    rows = products.repartition(parts, "l_orderkey").join(orders, F.expr("l.l_orderkey = o.o_orderkey"))
    return rows.selectExpr(*BASE_COLUMNS.split(",\n"))


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_row_hash(raw_base(spark, sf_dir))
