"""One whole run: landed pages to history, staging area, raw table and models."""

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from divtide.plans.load import Targets, load_batch
from divtide.plans.models import Day, build_models
from divtide.sources.pages import read_pages
from divtide.sources.warehouse import create_database, create_raw_table, read_raw


def targets_below(out: str, database: str, csv_staging: bool = False, **options) -> Targets:
    """The places of a run below one folder.

    With `csv_staging`, or where `null_tokens` are given, rows reach the table by way of CSV files.
    """
    staging = f"{out}/staging" if csv_staging or "null_tokens" in options else None
    places = {"walks": f"{out}/walks", "ledger": f"{out}/ledger"}
    return Targets(f"{out}/history", f"{out}/rejects", f"{database}.dividends", staging, **places, **options)


def run_once(
    spark: SparkSession,
    landing: str,
    out: str,
    database: str,
    as_of: Day = None,
    run_id: str | None = None,
    multi_line: bool = False,
    audit: bool = False,
    **options,
) -> tuple[dict[str, DataFrame], dict]:
    """Loads every page in `landing` and rebuilds the models; returns these and the counts.

    Doing a run again under the same `run_id` replaces what it stored. With `audit`, models whose rows lack
    values fail the run before readers see them.
    """
    targets = targets_below(out, database, **options)
    create_database(spark, database, f"{out}/warehouse")
    create_raw_table(spark, targets.table, by_batch=True)
    counts = load_batch(read_pages(spark, landing, multi_line), targets, run_id or uuid4().hex)
    return build_models(read_raw(spark, targets.table), database, as_of, audit), counts
