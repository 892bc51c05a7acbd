"""Table contracts of the four layers and the fixed value sets they rely on."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    VariantType,
)

STRING = StringType()
TIMESTAMP = TimestampNTZType()
QUANTITY = DecimalType(10, 0)
MONEY = DecimalType(18, 4)

# The 16 source columns, in file order.
BUSINESS_COLUMNS = [
    "order_id",
    "order_date",
    "customer_id",
    "customer_name",
    "product_id",
    "product_name",
    "category",
    "quantity",
    "unit_price",
    "total_amount",
    "currency",
    "region",
    "plant_code",
    "sap_document_type",
    "created_by",
    "status",
]

# Accepted codes.
STATUSES = ["COMPLETED", "PENDING", "FAILED", "CANCELLED"]
CURRENCIES = ["EUR", "USD", "GBP"]

# CSV texts that mean "missing" (the documented pandas defaults).
NULL_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

INGEST_COLUMNS = ["_pipeline_run_id", "_ingested_at", "_source_file", "_row_hash"]


def _schema(columns: dict[str, DataType]) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns.items()])


LANDING = _schema({name: STRING for name in BUSINESS_COLUMNS})

RAW = _schema(
    {
        **{name: STRING for name in BUSINESS_COLUMNS},
        "_pipeline_run_id": STRING,
        "_ingested_at": TIMESTAMP,
        "_source_file": STRING,
        "_row_hash": STRING,
    }
)

STAGING = _schema(
    {
        "order_id": STRING,
        "order_date": DateType(),
        "customer_id": STRING,
        "customer_name": STRING,
        "product_id": STRING,
        "product_name": STRING,
        "category": STRING,
        "quantity": QUANTITY,
        "unit_price": MONEY,
        "total_amount": MONEY,
        "currency": STRING,
        "region": STRING,
        "plant_code": STRING,
        "sap_document_type": STRING,
        "status": STRING,
        "_pipeline_run_id": STRING,
        "_ingested_at": TIMESTAMP,
        "_transformed_at": TIMESTAMP,
        "_is_valid": BooleanType(),
    }
)

# Deliveries of the raw table on their way into ``stg_sales``: one row when a load starts,
# another when it has ended.
DELIVERIES = _schema({"_pipeline_run_id": STRING, "delivery": STRING, "status": STRING, "at": TIMESTAMP})

# What has moved from the folder of its run into the folder of a day; see ``plans.closing``.
CLOSED_RUNS = _schema(
    {
        "_pipeline_run_id": STRING,
        "delivery": STRING,
        "_closed_day": STRING,
        "bytes": LongType(),
        "status": STRING,
        "at": TIMESTAMP,
    }
)


def closed_part(table: str) -> str:
    """Rows of the closed runs of a table that is partitioned by run."""
    return f"{table}_closed"


def closed_runs(table: str) -> str:
    """Which deliveries ``closed_part`` holds."""
    return f"{table}_closed_runs"


# Months of ``stg_sales`` that an order has been put into, kept apart from the rows.
ORDER_MONTHS = _schema({"order_id": STRING, "_order_month": STRING})

# Order ids in the fact, kept apart so that a load need not read the fact.
ORDER_IDS = _schema({"order_id": STRING})

# How often a key occurs in the rows of one delivery, for the keys that must be unique.
KEY_COUNTS = _schema({"name": STRING, "key": STRING, "delivery": STRING, "n": LongType()})

DIM_CUSTOMER = _schema(
    {
        "customer_sk": LongType(),
        "customer_id": STRING,
        "customer_name": STRING,
        "region": STRING,
        "_effective_from": DateType(),
        "_is_current": BooleanType(),
    }
)

DIM_PRODUCT = _schema(
    {
        "product_sk": LongType(),
        "product_id": STRING,
        "product_name": STRING,
        "category": STRING,
        "_effective_from": DateType(),
        "_is_current": BooleanType(),
    }
)

DIM_DATE = _schema(
    {
        "date_key": IntegerType(),
        "full_date": DateType(),
        "year": IntegerType(),
        "quarter": IntegerType(),
        "month": IntegerType(),
        "month_name": STRING,
        "week_of_year": IntegerType(),
        "day_of_week": STRING,
        "is_weekend": BooleanType(),
    }
)

FACT = _schema(
    {
        "order_sk": LongType(),
        "order_id": STRING,
        "date_key": IntegerType(),
        "customer_sk": LongType(),
        "product_sk": LongType(),
        "quantity": QUANTITY,
        "unit_price": MONEY,
        "total_amount": MONEY,
        "currency": STRING,
        "plant_code": STRING,
        "sap_document_type": STRING,
        "status": STRING,
        "_pipeline_run_id": STRING,
        "_loaded_at": TIMESTAMP,
    }
)

SALES_SUMMARY = _schema(
    {
        "year": IntegerType(),
        "month": IntegerType(),
        "month_name": STRING,
        "customer_name": STRING,
        "region": STRING,
        "category": STRING,
        "status": STRING,
        "order_count": LongType(),
        "total_quantity": DecimalType(38, 0),
        "total_revenue": DecimalType(38, 4),
        "avg_order_value": DecimalType(22, 8),
    }
)

# Sums and counts of the fact rows of each run, by month, status and surrogate keys.
SALES_TOTALS = _schema(
    {
        "year_month": IntegerType(),
        "year": IntegerType(),
        "month": IntegerType(),
        "month_name": STRING,
        "customer_sk": LongType(),
        "product_sk": LongType(),
        "status": STRING,
        "_orders": LongType(),
        "_quantity": DecimalType(38, 0),
        "_amount": DecimalType(38, 4),
        "_amounts": LongType(),
        "_pipeline_run_id": STRING,
    }
)

PRODUCT_SALES = _schema(
    {
        "product_id": STRING,
        "product_name": STRING,
        "category": STRING,
        "order_count": LongType(),
        "total_quantity": DecimalType(38, 0),
        "total_revenue": DecimalType(38, 4),
        "avg_order_value": DecimalType(22, 8),
    }
)

DQ_REPORT = _schema(
    {
        "run_id": STRING,
        "table_name": STRING,
        "total_rows": LongType(),
        "check_name": STRING,
        "passed": BooleanType(),
        "rows_affected": LongType(),
        "details": STRING,
    }
)

RUN_LOG = _schema(
    {
        "run_id": STRING,
        "pipeline_name": STRING,
        "start_time": TIMESTAMP,
        "end_time": TIMESTAMP,
        "status": STRING,
        "rows_ingested": LongType(),
        "rows_transformed": LongType(),
        "dq_pass_rate": DoubleType(),
        "error_message": STRING,
        "metadata_json": VariantType(),
    }
)


# What became of each step of a run; the entry follows the step.
STEPS = _schema({"run_id": STRING, "step": STRING, "status": STRING, "basis": STRING, "at": TIMESTAMP})


@dataclass(frozen=True)
class Layers:
    """Names of the four layer databases and of the tables in them.

    ``root`` is the folder new databases are created in; without it they go to the
    session's warehouse. Tables of keys start with ``order_buckets`` buckets, whose number
    doubles whenever they hold more than ``bucket_rows`` rows each.
    """

    raw: str = "raw"
    staging: str = "staging"
    dwh: str = "dwh"
    metrics: str = "metrics"
    root: str | None = None
    order_buckets: int = 16
    bucket_rows: int = 4_000_000

    @property
    def raw_sales_orders(self) -> str:
        return f"{self.raw}.raw_sales_orders"

    @property
    def raw_key_counts(self) -> str:
        """Occurrences of each order id and row hash in each delivery."""
        return f"{self.raw}.raw_key_counts"

    @property
    def raw_counted_deliveries(self) -> str:
        """Deliveries whose keys have been counted; written after the counts."""
        return f"{self.raw}.raw_counted_deliveries"

    @property
    def stg_sales_orders(self) -> str:
        """Deduplicated per run; feeds the star (first load of an order wins)."""
        return f"{self.staging}.stg_sales_orders"

    @property
    def stg_sales(self) -> str:
        """Upserted by order; the latest version of an order wins."""
        return f"{self.staging}.stg_sales"

    @property
    def stg_sales_keys(self) -> str:
        """Order ids of ``stg_sales`` and the months they are in."""
        return f"{self.stg_sales}_keys"

    @property
    def stg_sales_deliveries(self) -> str:
        """Deliveries that ``stg_sales`` holds, and those that a load has begun."""
        return f"{self.staging}.stg_sales_deliveries"

    @property
    def dim_customer(self) -> str:
        return f"{self.dwh}.dim_customer"

    @property
    def dim_product(self) -> str:
        return f"{self.dwh}.dim_product"

    @property
    def dim_date(self) -> str:
        return f"{self.dwh}.dim_date"

    @property
    def fact_sales_orders(self) -> str:
        return f"{self.dwh}.fact_sales_orders"

    @property
    def fact_order_ids(self) -> str:
        return f"{self.dwh}.fact_order_ids"

    @property
    def sales_summary(self) -> str:
        return f"{self.dwh}.sales_summary"

    @property
    def sales_totals(self) -> str:
        """What the summary adds up, kept by run."""
        return f"{self.dwh}.sales_totals"

    @property
    def dim_product_sales(self) -> str:
        return f"{self.dwh}.dim_product_sales"

    @property
    def dq_report(self) -> str:
        return f"{self.metrics}.dq_report"

    @property
    def pipeline_run_log(self) -> str:
        return f"{self.metrics}.pipeline_run_log"

    @property
    def pipeline_steps(self) -> str:
        return f"{self.metrics}.pipeline_steps"
