"""Command line: `ingest` keeps loading pages, `run` does it once, `models` only rebuilds, `check` fails on gaps,
`compact` merges the small files of the history.

    python -m divtide run --landing s3a://…/pages --out s3a://…/dividends --database dividends
"""

import argparse
import sys

from pyspark.sql import SparkSession

from divtide.operators.quality import not_null_report
from divtide.plans.models import build_models, refresh_after
from divtide.plans.run import run_once, targets_below
from divtide.sources.history import compact_history
from divtide.sources.warehouse import create_database, read_raw
from divtide.streaming.ingest import INTERVAL, start_ingest


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="divtide", description=__doc__.splitlines()[0])
    parser.add_argument("command", choices=["ingest", "run", "models", "check", "compact"])
    parser.add_argument("--database", required=True, help="catalog database of the raw table and the models")
    parser.add_argument("--out", required=True, help="shared folder for history, rejects, staging, checkpoint, tables")
    parser.add_argument("--landing", help="shared folder into which pages land")
    parser.add_argument("--as-of", help="day for the lifecycle stage (default: today)")
    parser.add_argument("--multi-line", action="store_true", help="each file is one page")
    parser.add_argument("--interval", default=INTERVAL, help="how often to look for pages")
    parser.add_argument("--max-files", type=int, default=0, help="files per batch (default: all)")
    parser.add_argument("--only-new", action="store_true", help="do not store rows that the history holds already")
    parser.add_argument("--audit", action="store_true", help="publish no models whose rows lack values they must have")
    parser.add_argument("--run-id", help="a run done again under its id replaces what it stored")
    parser.add_argument("--csv-staging", action="store_true", help="load the table by way of staged CSV files")
    options = parser.parse_args(argv)
    if options.command in ("ingest", "run") and not options.landing:
        parser.error("--landing is required")
    return options


def main(argv: list[str] | None = None) -> None:
    options = arguments(argv)
    spark = SparkSession.builder.appName("divtide").getOrCreate()
    targets = targets_below(options.out, options.database, options.csv_staging, only_new=options.only_new)
    if options.command == "run":
        _, counts = run_once(
            spark,
            options.landing,
            options.out,
            options.database,
            options.as_of,
            run_id=options.run_id,
            multi_line=options.multi_line,
            audit=options.audit,
            only_new=options.only_new,
            csv_staging=options.csv_staging,
        )
        print(counts)
    elif options.command == "models":
        build_models(read_raw(spark, targets.table), options.database, options.as_of, options.audit)
    elif options.command == "compact":
        print(f"{compact_history(spark, targets.history)} batches merged")
    elif options.command == "check":
        report = not_null_report(spark.table(f"{options.database}.stg_stock_dividends"))
        report.show(truncate=False)
        if not report.where("failures > 0").isEmpty():
            sys.exit(1)
    else:
        create_database(spark, options.database, f"{options.out}/warehouse")
        start_ingest(
            spark,
            options.landing,
            targets,
            f"{options.out}/checkpoint",
            max_files=options.max_files,
            interval=options.interval,
            after_batch=refresh_after(targets.table, options.database, options.as_of, options.audit),
            multi_line=options.multi_line,
        ).awaitTermination()


if __name__ == "__main__":
    main()
