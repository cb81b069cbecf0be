"""Command line: ``analyse``, ``load`` and ``report``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from flowgauge.plans.analysis import run_analysis, write_report
from flowgauge.plans.increment import load_increment
from flowgauge.schema import DEFAULT_SOURCE_ID
from flowgauge.sources.readers import load_cases


def add_reading(parser: argparse.ArgumentParser) -> None:
    database = parser.add_argument_group("database", "how an address is read; ranges of a column are read side by side")
    database.add_argument("--partition-column", dest="column")
    database.add_argument("--lower-bound", dest="lower")
    database.add_argument("--upper-bound", dest="upper")
    database.add_argument("--partitions", type=int, default=64)
    database.add_argument("--single-task", action="store_true", help="read all rows over one connection")


def reading(options: argparse.Namespace) -> dict:
    return {name: getattr(options, name) for name in ("column", "lower", "upper", "partitions", "single_task")}


def main() -> None:
    parser = argparse.ArgumentParser(prog="flowgauge")
    commands = parser.add_subparsers(dest="command", required=True)

    analyse = commands.add_parser("analyse", help="aggregates, models and insights of a case table")
    analyse.add_argument("--input", required=True, help="CSV, JSON or Parquet path, or a database address")
    add_reading(analyse)
    analyse.add_argument("--output-dir", default="output/analytics")
    analyse.add_argument("--trees", type=int, default=100)
    analyse.add_argument("--without-models", action="store_true")

    load = commands.add_parser("load", help="bring new cases of a source into a Parquet table")
    load.add_argument("--input", required=True)
    add_reading(load)
    load.add_argument("--target", required=True)
    load.add_argument("--state", required=True)
    load.add_argument("--source-id", default=DEFAULT_SOURCE_ID)
    load.add_argument("--strict", action="store_true", help="skip rows at the watermark itself")

    report = commands.add_parser("report", help="report tables of a finished analysis")
    report.add_argument("--output-dir", default="output/analytics")

    options = parser.parse_args()
    spark = (
        SparkSession.builder.appName("flowgauge").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    if options.command == "analyse":
        run_analysis(
            spark,
            options.input,
            options.output_dir,
            reading=reading(options),
            with_models=not options.without_models,
            trees=options.trees,
        )
    elif options.command == "load":
        done = load_increment(
            load_cases(spark, options.input, **reading(options)),
            options.target,
            options.state,
            options.source_id,
            strict=options.strict,
        )
        print(f"{done.inserted} rows inserted, {done.rejected} without an id set aside, watermark {done.watermark}")
    else:
        write_report(spark, options.output_dir)


if __name__ == "__main__":
    main()
