"""The registered queries as DuckDB SQL, written from the rules, not from the Spark plans."""

from __future__ import annotations

from gate.inputs import BASE_SQL, TABLES

BUSINESS = (
    "order_id order_date customer_id customer_name product_id product_name category quantity "
    "unit_price total_amount currency region plant_code sap_document_type created_by status"
).split()

_HASHED = ", ".join(f"coalesce({c}, 'nan')" for c in BUSINESS)

RAW = f"""
base AS ({BASE_SQL.format(**{name: name for name in TABLES})}),
raw_orders AS (SELECT *, md5(concat_ws('|', {_HASHED})) AS _row_hash FROM base)
"""

_DATE = (
    "CASE WHEN regexp_full_match(order_date, '[0-9]{4}-[0-9]{2}-[0-9]{2}') "
    "THEN try_cast(order_date AS DATE) END"
)
_INITCAP = (
    "array_to_string(list_transform(string_split(lower(trim(customer_name)), ' '), "
    "lambda w: upper(w[1]) || w[2:]), ' ')"
)
_VALID = {
    "strict": "order_date IS NOT NULL AND quantity IS NOT NULL AND quantity > 0 "
    "AND unit_price IS NOT NULL AND unit_price > 0",
    "lenient": "order_date IS NOT NULL AND quantity IS NOT NULL AND NOT coalesce(unit_price <= 0, FALSE)",
}
_LATEST = "_ingested_at DESC NULLS LAST, _row_hash, _pipeline_run_id"


def clean(source: str, rule: str) -> str:
    return f"""
    SELECT *, {_VALID[rule]} AS _is_valid FROM (
      SELECT order_id, {_DATE} AS order_date, nullif(trim(customer_id), '') AS customer_id,
        {_INITCAP} AS customer_name, product_id, trim(product_name) AS product_name,
        upper(trim(category)) AS category,
        try_cast(quantity AS DECIMAL(10,0)) AS quantity,
        try_cast(unit_price AS DECIMAL(18,4)) AS unit_price,
        try_cast(total_amount AS DECIMAL(18,4)) AS total_amount,
        upper(trim(currency)) AS currency, upper(trim(region)) AS region,
        upper(trim(plant_code)) AS plant_code, upper(trim(sap_document_type)) AS sap_document_type,
        upper(trim(status)) AS status, _pipeline_run_id, _ingested_at
      FROM ({source}))"""


def latest(source: str, keys: str, order: str = _LATEST) -> str:
    return (
        f"SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn "
        f"FROM {source}) WHERE rn = 1"
    )


_PLAIN = """order_id, CAST(order_date AS VARCHAR) AS order_date, customer_id, customer_name, product_id,
  product_name, category, CAST(quantity AS DOUBLE) AS quantity, CAST(unit_price AS DOUBLE) AS unit_price,
  CAST(total_amount AS DOUBLE) AS total_amount, currency, region, plant_code, sap_document_type, status,
  _pipeline_run_id"""
PLAIN_STAGED = _PLAIN + ", CAST(_ingested_at AS VARCHAR) AS _ingested_at, _is_valid"

STAGED = f"{RAW}, staged AS ({clean(latest('raw_orders', '_pipeline_run_id, order_id'), 'strict')})"


def member(name: str, key: str, attributes: str, where: str = "TRUE") -> str:
    """One row per key among valid rows: latest ingest, then smallest attributes."""
    return f"""{name} AS (
      SELECT {key}, {attributes} FROM (
        SELECT {key}, {attributes}, row_number() OVER (PARTITION BY {key}
          ORDER BY _ingested_at DESC NULLS LAST, {', '.join(f'{a} NULLS LAST' for a in attributes.split(', '))}) AS rn
        FROM staged WHERE _is_valid AND {key} IS NOT NULL AND {where}) WHERE rn = 1)"""


def two_loads(name: str, key: str, attributes: str, surrogate: str) -> str:
    """A dimension after both runs: keys of the first run, then the second run's new keys."""
    return f"""
    {member(name + '_1', key, attributes, "_pipeline_run_id = 'RUN_A'")},
    {member(name + '_2', key, attributes, "_pipeline_run_id = 'RUN_B'")},
    {name} AS (
      SELECT row_number() OVER (ORDER BY {key}) AS {surrogate}, {key}, {attributes} FROM {name}_1
      UNION ALL
      SELECT (SELECT count(*) FROM {name}_1) + row_number() OVER (ORDER BY {key}), {key}, {attributes}
      FROM {name}_2 WHERE {key} NOT IN (SELECT {key} FROM {name}_1))"""


_FACT_COLUMNS = """CAST(strftime(s.order_date, '%Y%m%d') AS INTEGER) AS date_key, c.customer_sk, p.product_sk,
      s.quantity, s.unit_price, s.total_amount, s.currency, s.plant_code, s.sap_document_type, s.status,
      s._pipeline_run_id"""

STAR = f"""{STAGED},
{two_loads('dim_customer', 'customer_id', 'customer_name, region', 'customer_sk')},
{two_loads('dim_product', 'product_id', 'product_name, category', 'product_sk')},
loaded AS (
  SELECT s.order_id, {_FACT_COLUMNS}
  FROM staged s
  LEFT JOIN dim_customer c ON s.customer_id = c.customer_id
  LEFT JOIN dim_product p ON s.product_id = p.product_id
  WHERE s._is_valid AND s.order_id IS NOT NULL),
fact_1 AS (
  SELECT row_number() OVER (ORDER BY date_key, status NULLS FIRST, order_id) AS order_sk, *
  FROM loaded WHERE _pipeline_run_id = 'RUN_A'),
fact_2 AS (
  SELECT (SELECT count(*) FROM fact_1) + row_number() OVER (ORDER BY date_key, status NULLS FIRST, order_id) AS order_sk, *
  FROM loaded WHERE _pipeline_run_id = 'RUN_B' AND order_id NOT IN (SELECT order_id FROM fact_1)),
fact AS (SELECT * FROM fact_1 UNION ALL SELECT * FROM fact_2)
"""

PLAIN_FACT = """order_sk, order_id, date_key, customer_sk, product_sk, CAST(quantity AS DOUBLE) AS quantity,
  CAST(unit_price AS DOUBLE) AS unit_price, CAST(total_amount AS DOUBLE) AS total_amount, currency, plant_code,
  sap_document_type, status, _pipeline_run_id, '2026-01-01 00:00:00' AS _loaded_at"""

TOTALS = """count(*) AS order_count, CAST(sum(f.quantity) AS DOUBLE) AS total_quantity,
  CAST(sum(f.total_amount) AS DOUBLE) AS total_revenue,
  CAST(CAST(round(CAST(sum(f.total_amount) AS DECIMAL(28,4)) * 1.0 / count(f.total_amount), 8) AS DECIMAL(22,8)) AS DOUBLE) AS avg_order_value"""

CALENDAR = """CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS VARCHAR) AS full_date,
  CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
  monthname(d) AS month_name, CAST(weekofyear(d) AS INTEGER) AS week_of_year, dayname(d) AS day_of_week,
  isodow(d) IN (6, 7) AS is_weekend"""

_NUMBERS = "quantity unit_price total_amount".split()
_QTY, _PRICE, _TOTAL = (f"try_cast({c} AS DECIMAL(18,6))" for c in _NUMBERS)

CHECKS = [
    ("No fully empty rows", f"sum(CASE WHEN {' AND '.join(f'{c} IS NULL' for c in BUSINESS)} THEN 1 ELSE 0 END)", "fully null rows found"),
    ("ORDER_ID not null", "sum(CASE WHEN order_id IS NULL THEN 1 ELSE 0 END)", "rows missing ORDER_ID"),
    ("CUSTOMER_ID not null", "sum(CASE WHEN customer_id IS NULL THEN 1 ELSE 0 END)", "rows missing CUSTOMER_ID"),
    (
        "No duplicate ORDER_IDs",
        "count(*) - count(DISTINCT order_id) - max(CASE WHEN order_id IS NULL THEN 1 ELSE 0 END)",
        "duplicate order IDs",
    ),
    ("QUANTITY > 0", f"sum(CASE WHEN {_QTY} <= 0 THEN 1 ELSE 0 END)", "rows with quantity <= 0"),
    ("UNIT_PRICE > 0", f"sum(CASE WHEN {_PRICE} <= 0 THEN 1 ELSE 0 END)", "rows with unit_price <= 0"),
    (
        "STATUS valid enum",
        "sum(CASE WHEN upper(status) IN ('COMPLETED', 'PENDING', 'FAILED', 'CANCELLED') THEN 0 ELSE 1 END)",
        "rows with invalid STATUS value",
    ),
    (
        "CURRENCY valid",
        "sum(CASE WHEN upper(currency) IN ('EUR', 'USD', 'GBP') THEN 0 ELSE 1 END)",
        "rows with unexpected currency",
    ),
    (
        "TOTAL_AMOUNT = QTY * PRICE",
        f"sum(CASE WHEN abs({_TOTAL} - {_QTY} * {_PRICE}) > 0.01 THEN 1 ELSE 0 END)",
        "rows with amount mismatch",
    ),
    ("ORDER_DATE parseable", f"sum(CASE WHEN {_DATE} IS NULL THEN 1 ELSE 0 END)", "rows with invalid date format"),
]

REPORT = ",\nreport AS (" + "\nUNION ALL\n".join(
    f"""SELECT 'RUN_ALL' AS run_id, 'RAW_SALES_ORDERS' AS table_name, total_rows, '{name}' AS check_name,
      n = 0 AS passed, n AS rows_affected,
      CASE WHEN n > 0 THEN CAST(n AS VARCHAR) || ' {text}' ELSE '' END AS details
    FROM (SELECT count(*) AS total_rows, CAST(coalesce({count}, 0) AS BIGINT) AS n FROM raw_orders)"""
    for name, count, text in CHECKS
) + ")"

_STREAM_BATCHES = ",\n".join(
    f"batch_{number} AS ("
    + clean(
        latest(
            f"(SELECT * REPLACE ('landing_{number:06d}' AS _pipeline_run_id) FROM raw_orders WHERE _pipeline_run_id = '{run}')",
            "order_id",
            "_row_hash",
        ),
        "lenient",
    )
    + ")"
    for number, run in enumerate(["RUN_A", "RUN_B"])
)

# The job's own ingest times: one for each run, so ties within a run go by the row hash.
_LANDED = RAW.replace("raw_orders AS (", "landed AS (") + """,
raw_orders AS (SELECT * REPLACE (CASE WHEN _pipeline_run_id = 'RUN_A' THEN TIMESTAMP '2026-01-01'
  ELSE TIMESTAMP '2026-01-02' END AS _ingested_at) FROM landed)"""
JOB_STAGED = STAGED.replace(RAW, _LANDED)
JOB_STAR = STAR.replace(RAW, _LANDED)

SUMMARY = f"""days AS (SELECT DISTINCT order_date AS d FROM staged WHERE _is_valid),
dim_date AS (SELECT {CALENDAR} FROM days)
SELECT d.year, d.month, d.month_name, c.customer_name, c.region, p.category, f.status, {TOTALS}
FROM fact f
LEFT JOIN dim_date d ON f.date_key = d.date_key
LEFT JOIN dim_customer c ON f.customer_sk = c.customer_sk
LEFT JOIN dim_product p ON f.product_sk = p.product_sk
GROUP BY 1, 2, 3, 4, 5, 6, 7"""

# Each run by itself; of an order that came twice the second run's version stays.
_DELIVERIES = ", ".join(
    f"batch_{number} AS ("
    + clean(
        latest(f"(SELECT * REPLACE ('{run}' AS _pipeline_run_id) FROM raw_orders WHERE {where})", "order_id", "_row_hash"),
        "lenient",
    )
    + ")"
    for number, (run, where) in enumerate(
        [("RUN_A", "_pipeline_run_id = 'RUN_A'"), ("RUN_B", "_pipeline_run_id = 'RUN_B' OR plant_code = 'pl1'")]
    )
)
_MERGED = f"""SELECT {_PLAIN}, _is_valid FROM (
  SELECT * FROM batch_0 a WHERE NOT EXISTS (SELECT 1 FROM batch_1 b WHERE b.order_id = a.order_id)
  UNION ALL SELECT * FROM batch_1)"""
_MODEL = f"WITH {RAW}, {_DELIVERIES} {_MERGED}"

_QUOTED = RAW.replace("base AS (", "plain_base AS (", 1).replace(
    "raw_orders AS",
    """base AS (SELECT * REPLACE (product_name || ', "' || category || '",' || chr(10) || region AS product_name)
  FROM plain_base),
raw_orders AS""",
)

_TESTS = {
    "raw_sales_orders.order_id not_null": "SELECT count(*) FROM raw_orders WHERE order_id IS NULL",
    "raw_sales_orders.order_id unique": "SELECT count(*) FROM (SELECT 1 FROM raw_orders WHERE order_id IS NOT NULL GROUP BY order_id HAVING count(*) > 1)",
    "raw_sales_orders.customer_id not_null": "SELECT count(*) FROM raw_orders WHERE customer_id IS NULL",
    "raw_sales_orders.total_amount not_null": "SELECT count(*) FROM raw_orders WHERE total_amount IS NULL",
    "raw_sales_orders._row_hash unique": "SELECT count(*) FROM (SELECT 1 FROM raw_orders GROUP BY _row_hash HAVING count(*) > 1)",
    "stg_sales.order_id not_null": "SELECT count(*) FROM stored WHERE order_id IS NULL",
    "stg_sales.order_id unique": "SELECT count(*) FROM (SELECT 1 FROM stored WHERE order_id IS NOT NULL GROUP BY order_id HAVING count(*) > 1)",
    "stg_sales.order_date not_null": "SELECT count(*) FROM stored WHERE order_date IS NULL",
    "stg_sales.status accepted_values": "SELECT count(*) FROM stored WHERE status NOT IN ('COMPLETED', 'PENDING', 'FAILED', 'CANCELLED')",
    "dim_product_sales.product_id not_null": "SELECT count(*) FROM fact f JOIN dim_product p USING (product_sk) WHERE p.product_id IS NULL",
    "fact_sales_orders.date_key references dim_date": "SELECT count(*) FROM fact WHERE date_key NOT IN (SELECT CAST(strftime(order_date, '%Y%m%d') AS INTEGER) FROM staged WHERE _is_valid)",
    "fact_sales_orders.customer_sk references dim_customer": "SELECT count(*) FROM fact WHERE customer_sk NOT IN (SELECT customer_sk FROM dim_customer)",
    "fact_sales_orders.product_sk references dim_product": "SELECT count(*) FROM fact WHERE product_sk NOT IN (SELECT product_sk FROM dim_product)",
}

ORACLE = {
    "staging_strict": f"WITH {STAGED} SELECT {PLAIN_STAGED} FROM staged",
    "staging_lenient": f"WITH {RAW} SELECT {PLAIN_STAGED} FROM ({clean(latest('raw_orders', 'order_id'), 'lenient')})",
    "staging_incremental": f"""WITH {RAW},
target AS ({clean(latest("(SELECT * FROM raw_orders WHERE _ingested_at <= TIMESTAMP '2000-01-01')", 'order_id'), 'lenient')}),
batch AS ({clean(latest("(SELECT * FROM raw_orders WHERE _ingested_at > (SELECT max(_ingested_at) FROM target))", 'order_id'), 'lenient')})
SELECT {PLAIN_STAGED} FROM (
  SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.order_id = t.order_id)
  UNION ALL SELECT * FROM batch)""",
    "row_hash": f"WITH {RAW} SELECT order_id, product_id, _row_hash FROM raw_orders",
    "ingest_metadata": """SELECT l_orderkey, l_linenumber, l_partkey, 'RUN_20260101_000000' AS _pipeline_run_id,
  '2026-01-01 00:00:00' AS _ingested_at, 'lineitem.parquet' AS _source_file FROM lineitem""",
    "upper_columns": f"""WITH {RAW} SELECT {', '.join(f'{c} AS {c.upper()}' for c in BUSINESS)},
  _pipeline_run_id AS _PIPELINE_RUN_ID, CAST(_ingested_at AS VARCHAR) AS _INGESTED_AT,
  _source_file AS _SOURCE_FILE, _row_hash AS _ROW_HASH FROM raw_orders""",
    "dq_report": f"WITH {RAW}{REPORT} SELECT * FROM report",
    "dq_overall": f"""WITH {RAW}{REPORT}
SELECT bool_and(passed) AS passed, avg(CASE WHEN passed THEN 1.0 ELSE 0.0 END) * 100 AS pass_rate,
  coalesce(string_agg(check_name, ', ' ORDER BY check_name) FILTER (WHERE NOT passed), '') AS failed_checks
FROM report""",
    "loadable_rows": f"""WITH {RAW} SELECT count(*) AS loadable_rows FROM raw_orders
WHERE order_id IS NOT NULL AND product_id IS NOT NULL""",
    "test_not_null": f"""WITH {RAW} SELECT order_id, product_id, customer_id, _row_hash FROM raw_orders
WHERE customer_id IS NULL""",
    "test_unique": f"""WITH {RAW} SELECT order_id, count(*) AS occurrences FROM raw_orders
WHERE order_id IS NOT NULL GROUP BY order_id HAVING count(*) > 1""",
    "test_accepted_values": f"""WITH {RAW}
SELECT order_id, status FROM ({clean(latest('raw_orders', 'order_id'), 'lenient')})
WHERE status NOT IN ('COMPLETED', 'PENDING', 'FAILED', 'CANCELLED')""",
    "test_orphans": f"""WITH {STAGED}
SELECT order_id, product_id, _pipeline_run_id FROM staged s
WHERE product_id IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM staged k WHERE k.product_id = s.product_id AND k._is_valid AND k._pipeline_run_id = 'RUN_A')""",
    "dup_by_hash": f"""WITH {RAW}
SELECT _row_hash, count(*) - 1 AS extra_rows
FROM (SELECT * FROM raw_orders UNION ALL (SELECT * FROM raw_orders WHERE plant_code = 'pl1'))
GROUP BY _row_hash HAVING count(*) > 1""",
    "dim_customer": f"""WITH {STAGED}, {member('m', 'customer_id', 'customer_name, region')}
SELECT row_number() OVER (ORDER BY customer_id) AS customer_sk, *, '2026-01-01' AS _effective_from,
  TRUE AS _is_current FROM m""",
    "dim_product": f"""WITH {STAGED}, {member('m', 'product_id', 'product_name, category')}
SELECT row_number() OVER (ORDER BY product_id) AS product_sk, *, '2026-01-01' AS _effective_from,
  TRUE AS _is_current FROM m""",
    "dim_merge_insert_only": f"""WITH {STAGED},
{two_loads('dim_customer', 'customer_id', 'customer_name, region', 'customer_sk')}
SELECT *, '2026-01-01' AS _effective_from, TRUE AS _is_current FROM dim_customer""",
    "dim_date": f"""SELECT {CALENDAR} FROM (
  SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS DATE) AS d
  FROM orders)""",
    "fact_orders": f"WITH {STAR} SELECT {PLAIN_FACT} FROM fact",
    "fact_second_run": f"WITH {STAR} SELECT {PLAIN_FACT} FROM fact_2",
    "sales_summary": f"WITH {STAR}, {SUMMARY}",
    "product_sales": f"""WITH {STAR}
SELECT p.product_id, p.product_name, p.category, {TOTALS}
FROM fact f JOIN dim_product p ON f.product_sk = p.product_sk GROUP BY 1, 2, 3""",
    "natural_summary": f"""WITH {RAW}
SELECT region, category, status, count(*) AS order_count, CAST(sum(quantity) AS DOUBLE) AS total_quantity,
  CAST(sum(total_amount) AS DOUBLE) AS total_revenue
FROM ({clean(latest('raw_orders', 'order_id'), 'strict')}) WHERE _is_valid GROUP BY 1, 2, 3""",
    "run_log": f"""WITH {RAW}{REPORT}
SELECT 'RUN_ALL' AS run_id, 'SALES_ETL_PIPELINE' AS pipeline_name, '2026-01-01 00:00:00' AS start_time,
  '2026-01-01 00:05:00' AS end_time, 'SUCCESS' AS status,
  (SELECT count(*) FROM raw_orders) AS rows_ingested,
  (SELECT count(*) FROM raw_orders WHERE order_id IS NOT NULL AND product_id IS NOT NULL) AS rows_transformed,
  (SELECT avg(CASE WHEN passed THEN 1.0 ELSE 0.0 END) * 100 FROM report) AS dq_pass_rate,
  '' AS error_message, (SELECT count(*) FROM raw_orders) AS metadata_rows_ingested""",
    "csv_roundtrip": f"WITH {RAW} SELECT {', '.join(BUSINESS)} FROM raw_orders",
    "csv_quoted_text": f"WITH {_QUOTED} SELECT {', '.join(BUSINESS)} FROM raw_orders",
    "ingestion_records": f"""WITH {_QUOTED},
runs AS (SELECT CASE WHEN _pipeline_run_id = 'RUN_A' THEN 0 ELSE 1 END AS delivery, count(*) AS n,
    count(*) FILTER (WHERE order_id IS NOT NULL AND product_id IS NOT NULL) AS loadable,
    count(DISTINCT _row_hash) AS row_hashes
  FROM raw_orders GROUP BY 1)
SELECT delivery, CASE WHEN delivery = 0 THEN 'given' ELSE 'made' END AS id_kind, 'SUCCESS' AS status,
  n AS rows_ingested, 0 AS rows_malformed, sum(n) OVER (ORDER BY delivery) AS raw_table_rows, loadable,
  n AS stored_rows, row_hashes, TRUE AS stamped_within_run
FROM runs""",
    "stream_landing": f"""WITH {RAW}, {_STREAM_BATCHES}
SELECT {_PLAIN}, _is_valid FROM (
  SELECT * FROM batch_0 a WHERE NOT EXISTS (SELECT 1 FROM batch_1 b WHERE b.order_id = a.order_id)
  UNION ALL SELECT * FROM batch_1)""",
    "stream_two_sources": f"""WITH {RAW}, {_STREAM_BATCHES.replace("landing_000001", "landing_000000")} {_MERGED}""",
    "model_refresh": _MODEL,
    "late_run": _MODEL,
    "second_delivery": _MODEL.replace("('RUN_B' AS _pipeline_run_id)", "('RUN_A' AS _pipeline_run_id)"),
    "pipeline_run": f"WITH {JOB_STAR}, {SUMMARY}",
    "pipeline_fact": f"""WITH {JOB_STAR} SELECT {PLAIN_FACT.replace(", '2026-01-01 00:00:00' AS _loaded_at", "")} FROM fact""",
    "clustered_tables": f"""WITH {JOB_STAR}
SELECT 'stg_sales_orders' AS table_name, _pipeline_run_id, count(*) AS n_rows,
  min(CAST(strftime(order_date, '%Y%m%d') AS INTEGER)) AS first_day,
  max(CAST(strftime(order_date, '%Y%m%d') AS INTEGER)) AS last_day, 0 AS overlapping_files
FROM staged GROUP BY _pipeline_run_id
UNION ALL
SELECT 'fact_sales_orders', _pipeline_run_id, count(*), min(date_key), max(date_key), 0
FROM fact GROUP BY _pipeline_run_id""",
    "closed_run_rows": f"""WITH {JOB_STAR},
latest AS ({latest('raw_orders', 'order_id')})
SELECT _pipeline_run_id, r.raw_rows, r.row_hashes, s.staged_rows, s.valid_rows, s.total_amount, f.fact_rows,
  l.latest_rows, 0 AS raw_folders, CASE WHEN _pipeline_run_id = 'RUN_A' THEN 1 ELSE 0 END AS staging_folders
FROM (SELECT _pipeline_run_id, count(*) AS raw_rows, count(DISTINCT _row_hash) AS row_hashes
  FROM raw_orders GROUP BY 1) r
JOIN (SELECT _pipeline_run_id, count(*) AS staged_rows, count(*) FILTER (WHERE _is_valid) AS valid_rows,
  CAST(sum(total_amount) AS DOUBLE) AS total_amount FROM staged GROUP BY 1) s USING (_pipeline_run_id)
JOIN (SELECT _pipeline_run_id, count(*) AS fact_rows FROM fact GROUP BY 1) f USING (_pipeline_run_id)
JOIN (SELECT _pipeline_run_id, count(*) AS latest_rows FROM latest GROUP BY 1) l USING (_pipeline_run_id)""",
    "run_metadata": f"""WITH {JOB_STAGED}
SELECT r._pipeline_run_id, 'SALES_ETL_PIPELINE' AS pipeline_name, 'SUCCESS' AS status, count(*) AS rows_ingested,
  count(*) FILTER (WHERE order_id IS NOT NULL AND product_id IS NOT NULL) AS rows_transformed, '' AS error_message,
  'SUCCESS' AS fact_step, count(*) AS raw_rows, any_value(s.n) AS staged_rows
FROM raw_orders r JOIN (SELECT _pipeline_run_id, count(*) AS n FROM staged GROUP BY 1) s USING (_pipeline_run_id)
GROUP BY r._pipeline_run_id""",
    "declared_tests": f"""WITH {JOB_STAR}, stored AS ({clean(latest('raw_orders', 'order_id'), 'lenient')})
{" UNION ALL ".join(f"SELECT '{name}' AS test, ({sql}) AS failing" for name, sql in _TESTS.items())}""",
}
