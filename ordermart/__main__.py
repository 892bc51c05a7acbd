"""Command line for spark-submit: ``python -m ordermart run landing/2024-01-15``."""

from __future__ import annotations

import argparse
import json
import logging
from datetime import datetime

from ordermart.functions.columns import DATE_FORMATS
from ordermart.plans.batch import run_full_pipeline
from ordermart.plans.closing import close_runs
from ordermart.plans.ingestion import run_ingestion
from ordermart.plans.models import count_failures, refresh_product_sales, refresh_stg_sales
from ordermart.plans.runlog import utc_now
from ordermart.plans.transformation import run_transformations
from ordermart.schemas import Layers
from ordermart.session import build_session
from ordermart.sources.landing import DEFAULT_SOURCE
from ordermart.streaming.landing import run_landing_stream


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="ordermart", description=__doc__)
    parser.add_argument("--root", help="folder of the databases, else the session's warehouse")
    parser.add_argument("--multi-line", action="store_true", help="line breaks inside quotes belong to the text")
    parser.add_argument("--date-format", action="append", help="pattern of order dates; may be given again")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, text in [("run", "whole job for a set of files"), ("ingest", "files to the raw layer")]:
        command = commands.add_parser(name, help=text)
        command.add_argument("source", nargs="*", default=[DEFAULT_SOURCE])
        command.add_argument("--run-id")
    transform = commands.add_parser("transform", help="one ingested run to staging and star")
    transform.add_argument("run_id")
    transform.add_argument("--dimensions-from", choices=["run", "all"], default="run")
    commands.add_parser("models", help="incremental staging, product rollup and their tests")
    close = commands.add_parser("close", help="merge the folders of older runs into one a day")
    close.add_argument("before", type=datetime.fromisoformat, help="UTC time the runs were ingested before")
    stream = commands.add_parser("stream", help="load the files that arrived since the last call")
    stream.add_argument("directory")
    stream.add_argument("checkpoint")
    stream.add_argument("--name", default="landing", help="first part of the run ids")
    return parser.parse_args(arguments)


def main(arguments: list[str] | None = None) -> dict:
    options = parse(arguments)
    logging.basicConfig(level=logging.INFO)
    spark = build_session()
    layers = Layers(root=options.root)
    formats = {"date_formats": options.date_format or DATE_FORMATS}
    reading = {"multi_line": options.multi_line, **formats}
    if options.command == "run":
        result = run_full_pipeline(spark, options.source, options.run_id, layers, **reading)
    elif options.command == "ingest":
        result = run_ingestion(spark, options.source, options.run_id, layers, **reading)
    elif options.command == "transform":
        result = run_transformations(
            spark, options.run_id, layers=layers, dimensions_from=options.dimensions_from, **formats
        )
    elif options.command == "models":
        refresh_stg_sales(spark, utc_now(), layers, **formats)
        refresh_product_sales(spark, layers)
        result = count_failures(spark, layers)
    elif options.command == "close":
        result = close_runs(spark, options.before, layers)
    else:
        run_landing_stream(spark, options.directory, options.checkpoint, layers, name=options.name, **reading)
        result = {"status": "SUCCESS"}
    print(json.dumps(result, default=str, indent=2))
    return result


if __name__ == "__main__":
    main()
