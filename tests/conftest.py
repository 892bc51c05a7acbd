from __future__ import annotations

import sys
import uuid
from pathlib import Path

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from ordermart.operators.ingest import with_row_hash  # noqa: E402
from ordermart.schemas import BUSINESS_COLUMNS, LANDING, Layers  # noqa: E402
from ordermart.session import RECOMMENDED  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = SparkSession.builder.master("local[8]").appName("ordermart-tests")
    settings = {
        **RECOMMENDED,
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def layers(tmp_path):
    tag = uuid.uuid4().hex[:8]
    return Layers(f"raw_{tag}", f"staging_{tag}", f"dwh_{tag}", f"metrics_{tag}", root=str(tmp_path / "db"))


# One complete order; tests override what they are about.
ORDER = {
    "order_id": "ORD-001",
    "order_date": "2024-01-15",
    "customer_id": "CUST-101",
    "customer_name": "Customer A",
    "product_id": "PROD-500",
    "product_name": "Pump",
    "category": "HE",
    "quantity": "10",
    "unit_price": "1250.00",
    "total_amount": "12500.00",
    "currency": "EUR",
    "region": "EMEA",
    "plant_code": "DE01",
    "sap_document_type": "ZOR",
    "created_by": "SYSTEM",
    "status": "COMPLETED",
}


INGEST = {"_pipeline_run_id": "R1", "_ingested_at": "2024-02-01 00:00:00", "_source_file": "a.csv"}


@pytest.fixture
def orders(spark):
    """Build a landing DataFrame from overrides of one complete order."""

    def build(*rows: dict):
        values = [tuple({**ORDER, **row}[name] for name in BUSINESS_COLUMNS) for row in rows]
        return spark.createDataFrame(values, LANDING).coalesce(2)

    return build


@pytest.fixture
def raw(spark):
    """Build raw rows: overrides may also set run id, ingest time and source file."""

    def build(*rows: dict):
        names = [*BUSINESS_COLUMNS, *INGEST]
        values = [tuple({**ORDER, **INGEST, **row}[name] for name in names) for row in rows]
        df = spark.createDataFrame(values, ", ".join(f"{name} string" for name in names)).coalesce(2)
        return with_row_hash(df.withColumn("_ingested_at", F.col("_ingested_at").cast("timestamp_ntz")))

    return build


def write_csv(path, rows: list[dict]):
    """A landing file from overrides of one complete order."""
    import csv

    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="") as out:
        writer = csv.DictWriter(out, BUSINESS_COLUMNS)
        writer.writeheader()
        for row in rows:
            writer.writerow({k: "" if v is None else v for k, v in {**ORDER, **row}.items()})
    return str(path)
