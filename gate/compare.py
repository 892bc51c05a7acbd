"""Compare registered queries with their SQL counterparts by value.

    python -m gate.compare [folder of tables] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from gate.oracle import ORACLE
from gate.spark_queries import QUERIES


def canonical(frame) -> list[tuple]:
    """Rows as sorted tuples of text, columns by name."""
    frame = frame[sorted(frame.columns)]

    def text(value) -> str:
        if pd.isna(value):
            return "NULL"
        if isinstance(value, bool) or type(value).__name__ == "bool_":
            return str(bool(value))
        if isinstance(value, (int, float)) or hasattr(value, "dtype"):
            return repr(float(value))
        return str(value)

    return sorted(tuple(text(v) for v in row) for row in frame.itertuples(index=False, name=None))


def oracle_frame(sf_dir: str, sql: str):
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection.execute(sql).df()


def differences(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Empty text when both sides agree, else what differs first."""
    got = QUERIES[name](spark, sf_dir).toPandas()
    expected = oracle_frame(sf_dir, ORACLE[name])
    if sorted(got.columns) != sorted(expected.columns):
        return f"columns {sorted(got.columns)} != {sorted(expected.columns)}"
    if len(got) != len(expected):
        return f"{len(got)} rows != {len(expected)} rows"
    left, right = canonical(got), canonical(expected)
    different = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(different)} rows differ, first {different[0]}" if different else ""


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in names:
        started = time.time()
        problem = differences(spark, sf_dir, name)
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok':4} {name:24} {time.time() - started:6.1f}s {problem}", flush=True)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
