"""Every operator as a query over the given tables."""

from collections.abc import Callable
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from divtide.functions import blank_null_tokens, clean_text, frequency_label, lifecycle_stage, person_message
from divtide.functions import as_date, as_double, as_long
from divtide.operators.admission import admit_pages, ok_pages
from divtide.operators.dedup import drop_null_keys, keep_latest
from divtide.operators.normalize import conform, strict_union, union_rows
from divtide.operators.quality import LEDGER, batch_metrics, current_counts, not_null_report
from divtide.operators.totals import ticker_year_totals, with_change, with_previous_year
from divtide.plans import fixtures as fx
from divtide.plans.load import Targets, load_batch
from divtide.plans.models import (
    AuditError,
    build_models,
    clean_columns,
    dimension,
    refresh_models,
    staging,
    summary,
    trends,
)
from divtide.plans.run import run_once
from divtide.session import kept_once, scratch_dir
from divtide.sources.history import append_form, append_history, compact_history, read_history
from divtide.sources.pages import page_rows, people, read_nested, read_pages
from divtide.sources.parts import PartTable
from divtide.sources.row_index import row_index, rows_not_held
from divtide.sources.staging_csv import clear_staging, read_staging, write_staging
from divtide.sources.warehouse import append_raw, create_database, create_raw_table, read_raw
from divtide.streaming.ingest import ingest_available

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        return build

    return register


def stg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging(fx.raw_dividends(spark, sf_dir), fx.AS_OF)


def dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimension(stg(spark, sf_dir))


def database(spark: SparkSession) -> str:
    name = f"divtide_{uuid4().hex}"
    create_database(spark, name, scratch_dir(spark, "warehouse"))
    return name


# Sources


@query("json_pages_scan")
def json_pages_scan(spark, sf_dir):
    landing = scratch_dir(spark, "pages")
    fx.land_pages(fx.raw_dividends(spark, sf_dir), landing)
    return page_rows(read_pages(spark, landing))


@query("page_admission")
def page_admission(spark, sf_dir):
    return admit_pages(fx.page_log(spark, sf_dir), order="page")


@query("page_ok_filter")
def page_ok_filter(spark, sf_dir):
    return ok_pages(fx.page_log(spark, sf_dir))


@query("empty_page")
def empty_page(spark, sf_dir):
    """Orders as pages without `results`, with empty `results`, or with one row."""
    landing = scratch_dir(spark, "pages")
    row = F.struct(F.col("o_orderkey").cast("string").alias("id"), F.lit("filled").alias("dividend_type"))
    results = F.when(F.col("o_orderkey") % 3 == 1, F.filter(F.array(row), lambda _: F.lit(False))).when(
        F.col("o_orderkey") % 3 == 2, F.array(row)
    )
    fx.table(spark, sf_dir, "orders").select(F.lit("OK").alias("status"), results.alias("results")).write.json(landing)

    pages = read_pages(spark, landing)
    rows = page_rows(pages)
    kind = F.when(F.col("results").isNull(), "missing").when(F.size("results") == 0, "empty").otherwise("filled")
    counted = pages.select(kind.alias("kind"), F.lit(1).alias("page"), F.lit(0).alias("row")).unionByName(
        rows.select(F.coalesce("dividend_type", F.lit("none")).alias("kind"), F.lit(0).alias("page"), F.lit(1).alias("row"))
    )
    return counted.groupBy("kind").agg(
        F.sum("page").alias("pages"),
        F.sum("row").alias("row_count"),
        F.lit(len(rows.columns)).alias("column_count"),
    )


@query("fallback_relation")
def fallback_relation(spark, sf_dir):
    landed, missing = scratch_dir(spark, "people"), scratch_dir(spark, "people")
    fx.land_people(spark, sf_dir, landed)
    sources = {"landed": people(spark, landed), "fallback": people(spark, missing)}
    return reduce(DataFrame.unionByName, [df.withColumn("source", F.lit(name)) for name, df in sources.items()])


@query("explode_rows")
def explode_rows(spark, sf_dir):
    landed = scratch_dir(spark, "people")
    fx.land_people(spark, sf_dir, landed)
    return people(spark, landed).withColumn("message", person_message(F.col("name"), F.col("craft")))


@query("nested_flatten")
def nested_flatten(spark, sf_dir):
    landing = scratch_dir(spark, "pages")
    due = F.struct(F.col("pay_date").alias("pay"), F.col("record_date").alias("record"))
    nested = fx.raw_dividends(spark, sf_dir).select(
        "id",
        F.struct(as_double(F.col("cash_amount")).alias("cash"), "currency").alias("amount"),
        F.struct(F.col("ex_dividend_date").alias("ex"), due.alias("due")).alias("dates"),
        as_long(F.col("frequency")).alias("frequency"),
    )
    fx.land_pages(nested, landing)
    flat = read_nested(spark, landing, nested.schema)
    return flat.toDF(*[c.replace(".", "_") for c in flat.columns])


# History, staging area, raw table


@query("history_evolve")
def history_evolve(spark, sf_dir):
    """Two writes of an older form (typed columns, one missing, one more), and one of today's."""
    history = scratch_dir(spark, "history")
    raw = fx.raw_dividends(spark, sf_dir)
    typed = {
        "cash_amount": as_double(F.col("cash_amount")),
        "frequency": as_long(F.col("frequency")),
        "record_date": as_date(F.col("record_date")),
        "note": F.lit("old"),
    }
    older = fx.first_part(raw).withColumns(typed).drop("currency")
    append_form(older.where("id IS NULL"), history)
    append_history(fx.other_part(raw), history)
    append_form(older.where("id IS NOT NULL"), history)
    return read_history(spark, history)


@query("history_append")
def history_append(spark, sf_dir):
    history = scratch_dir(spark, "history")
    raw = fx.raw_dividends(spark, sf_dir)
    append_history(fx.first_part(raw), history)
    append_history(fx.other_part(raw), history)
    return read_history(spark, history)


@query("history_append_new")
def history_append_new(spark, sf_dir):
    history = scratch_dir(spark, "history")
    raw = fx.raw_dividends(spark, sf_dir)
    append_history(fx.first_part(raw), history, "first")
    index = row_index(spark, f"{history}_index", history)
    append_history(rows_not_held(kept_once(raw, "batch"), index, history, "second"), history, "second")
    return read_history(spark, history)


@query("history_compacted")
def history_compacted(spark, sf_dir):
    """Batches are merged, one of them is stored again with other rows, one comes new, and all are merged again."""
    history = scratch_dir(spark, "history")
    first, second, third = fx.three_parts(fx.raw_dividends(spark, sf_dir))
    append_history(first, history, "a")
    append_history(second.unionByName(first), history, "b")
    compact_history(spark, history)
    append_history(second, history, "b")
    append_history(third, history, "c")
    compact_history(spark, history)
    return read_history(spark, history)


@query("batch_repeat")
def batch_repeat(spark, sf_dir):
    """Two batches are stored, then one of them again from pages without rows, which leaves the other's."""
    landings = [scratch_dir(spark, "pages") for _ in range(3)]
    root = scratch_dir(spark, "repeat")
    raw = fx.raw_dividends(spark, sf_dir)
    fx.land_pages(fx.first_part(raw), landings[0])
    fx.land_pages(fx.other_part(raw), landings[1])
    fx.land_empty_pages(spark, sf_dir, landings[2])
    targets = Targets(f"{root}/history", f"{root}/rejects", f"{database(spark)}.dividends")
    create_raw_table(spark, targets.table, by_batch=True)
    for batch, landing in (("a", landings[0]), ("b", landings[1]), ("a", landings[2])):
        load_batch(read_pages(spark, landing), targets, batch)
    sinks = {"history": read_history(spark, targets.history), "table": read_raw(spark, targets.table)}
    return reduce(DataFrame.unionByName, [df.withColumn("sink", F.lit(name)) for name, df in sinks.items()])


@query("rejected_pages")
def stored_rejects(spark, sf_dir):
    """Pages made from orders, good, of wrong form and cut off; the stored text of those rejected."""
    landing, root = scratch_dir(spark, "pages"), scratch_dir(spark, "rejects")
    fx.land_odd_pages(spark, sf_dir, landing)
    targets = Targets(f"{root}/history", f"{root}/rejects", f"{database(spark)}.dividends")
    create_raw_table(spark, targets.table, by_batch=True)
    load_batch(read_pages(spark, landing), targets, "odd")
    return spark.read.schema("page string").json(targets.rejects).select("page")


@query("union_all")
def union_all(spark, sf_dir):
    raw = fx.raw_dividends(spark, sf_dir)
    return union_rows(raw, fx.first_part(raw))


@query("strict_union")
def strict_union_rows(spark, sf_dir):
    raw = fx.raw_dividends(spark, sf_dir)
    return strict_union(fx.first_part(raw), fx.other_part(raw))


@query("staging_csv_roundtrip")
def staging_csv_roundtrip(spark, sf_dir):
    staged = scratch_dir(spark, "staging")
    write_staging(fx.raw_dividends(spark, sf_dir), staged)
    return read_staging(spark, staged)


@query("staging_csv_clear")
def staging_csv_clear(spark, sf_dir):
    staged = scratch_dir(spark, "staging")
    write_staging(fx.raw_dividends(spark, sf_dir), staged)
    before = read_staging(spark, staged).count()
    clear_staging(spark, staged)
    cleared = read_staging(spark, staged)
    return cleared.agg(
        F.lit(before).cast("bigint").alias("rows_before"),
        F.count("*").alias("rows_after"),
        F.lit(len(cleared.columns)).alias("column_count"),
    )


@query("null_tokens")
def null_tokens(spark, sf_dir):
    return blank_null_tokens(fx.raw_dividends(spark, sf_dir))


@query("warehouse_append")
def warehouse_append(spark, sf_dir):
    raw = fx.raw_dividends(spark, sf_dir)
    table = f"{database(spark)}.dividends"
    create_raw_table(spark, table)
    append_raw(fx.first_part(raw), table)
    create_raw_table(spark, table)
    append_raw(fx.other_part(raw), table)
    return read_raw(spark, table)


@query("microbatch_replay")
def microbatch_replay(spark, sf_dir):
    """Half the pages land, are loaded, the other half land, are loaded; a third run finds nothing."""
    landing, root = scratch_dir(spark, "pages"), scratch_dir(spark, "stream")
    targets = Targets(f"{root}/history", f"{root}/rejects", f"{database(spark)}.dividends")
    raw = fx.raw_dividends(spark, sf_dir)
    for part in (fx.first_part(raw), fx.other_part(raw), None):
        if part is not None:
            fx.land_pages(part, landing)
        ingest_available(spark, landing, targets, f"{root}/checkpoint")
    sinks = {"history": read_history(spark, targets.history), "table": read_raw(spark, targets.table)}
    return reduce(DataFrame.unionByName, [df.withColumn("sink", F.lit(name)) for name, df in sinks.items()])


@query("admitted_ingest")
def admitted_ingest(spark, sf_dir):
    """Walks over pages that land in three parts, and pages of no walk; stored are rows of pages a walk reaches,
    and of pages without one that did not fail."""
    landing, root = scratch_dir(spark, "pages"), scratch_dir(spark, "stream")
    table = f"{database(spark)}.dividends"
    targets = Targets(f"{root}/history", f"{root}/rejects", table, walks=f"{root}/walks")
    for low, high in ((0, 2), (2, 4), (4, None)):
        fx.land_walks(spark, sf_dir, landing, low, high)
        if low == 2:
            fx.land_loose_pages(spark, sf_dir, landing)
        ingest_available(spark, landing, targets, f"{root}/checkpoint")
    sinks = {"history": read_history(spark, targets.history), "table": read_raw(spark, targets.table)}
    rows = [df.select("id", "ticker", F.lit(name).alias("sink")) for name, df in sinks.items()]
    return reduce(DataFrame.unionByName, rows)


@query("batch_metrics")
def batch_counts(spark, sf_dir):
    raw = fx.raw_dividends(spark, sf_dir)
    return batch_metrics(fx.other_part(raw), fx.first_part(raw))


@query("load_ledger")
def load_ledger(spark, sf_dir):
    """Two batches are loaded, then one of them again from pages without rows; rows by batch and of the history."""
    landings = [scratch_dir(spark, "pages") for _ in range(3)]
    root = scratch_dir(spark, "ledger")
    raw = fx.raw_dividends(spark, sf_dir)
    fx.land_pages(fx.first_part(raw), landings[0])
    fx.land_pages(fx.other_part(raw), landings[1])
    fx.land_empty_pages(spark, sf_dir, landings[2])
    targets = Targets(f"{root}/history", f"{root}/rejects", f"{database(spark)}.dividends", ledger=f"{root}/ledger")
    create_raw_table(spark, targets.table, by_batch=True)
    for batch, landing in (("a", landings[0]), ("b", landings[1]), ("a", landings[2])):
        counts = load_batch(read_pages(spark, landing), targets, batch)
    ledger = PartTable(spark, targets.ledger, LEDGER, ["batch"])
    return current_counts(ledger.read()).select("batch", "rows", F.lit(counts["rows_after"]).cast("long").alias("rows_after"))


# Projections and scalar functions, on every raw row


@query("normalize_schema")
def normalize_schema(spark, sf_dir):
    lineitem = fx.table(spark, sf_dir, "lineitem")
    return conform(
        lineitem.select(
            F.col("l_suppkey").alias("ticker"),
            F.col("l_orderkey").alias("id"),
            F.col("l_linenumber").alias("frequency"),
            (F.floor("l_quantity") + 0.25).alias("cash_amount"),
            F.col("l_shipdate").cast("date").alias("record_date"),
            F.col("l_linestatus").alias("dividend_type"),
            F.col("l_tax").alias("rate"),
        )
    )


@query("clean_strings")
def clean_strings(spark, sf_dir):
    clean = {c: clean_text(F.col(c)) for c in ("ticker", "currency")}
    return fx.raw_dividends(spark, sf_dir).select("id", *[value.alias(c) for c, value in clean.items()])


@query("typed_casts")
def typed_casts(spark, sf_dir):
    """Casts of every raw row, some of whose dates have other text after them or are a year only."""
    raw = fx.raw_dividends(spark, sf_dir)
    date = F.col("declaration_date")
    odd = (
        F.when(F.col("ticker") == "NA", F.concat(date, F.lit(" junk")))
        .when(F.col("frequency") == "1", F.concat(date, F.lit("Tjunk")))
        .when(F.col("frequency") == "2", F.substring(date, 1, 4))
        .otherwise(date)
    )
    typed = clean_columns(raw.withColumn("declaration_date", odd))
    return typed.drop("ticker", "currency", "dividend_type")


@query("lifecycle_stage")
def lifecycle_stages(spark, sf_dir):
    typed = clean_columns(fx.raw_dividends(spark, sf_dir))
    return typed.withColumn("dividend_lifecycle_stage", lifecycle_stage(fx.AS_OF))


@query("frequency_label")
def frequency_labels(spark, sf_dir):
    typed = clean_columns(fx.raw_dividends(spark, sf_dir))
    label = frequency_label(F.col("frequency")).alias("dividend_frequency")
    return typed.select("dividend_id", "frequency", label)


# Deduplication, models, checks


@query("drop_null_ids")
def drop_null_ids(spark, sf_dir):
    return drop_null_keys(fx.raw_dividends(spark, sf_dir))


@query("dedup_latest")
def dedup_latest(spark, sf_dir):
    return keep_latest(drop_null_keys(fx.raw_dividends(spark, sf_dir)))


@query("stg_dividends")
def stg_dividends(spark, sf_dir):
    return stg(spark, sf_dir).drop("loaded_at")


@query("dim_dividends")
def dim_dividends(spark, sf_dir):
    return dim(spark, sf_dir).drop("loaded_at")


@query("fct_dividend_summary")
def fct_dividend_summary(spark, sf_dir):
    return summary(dim(spark, sf_dir))


@query("ticker_year_totals")
def ticker_year_total(spark, sf_dir):
    return ticker_year_totals(dim(spark, sf_dir))


@query("lag_prev_year")
def lag_prev_year(spark, sf_dir):
    return with_previous_year(ticker_year_totals(dim(spark, sf_dir)))


@query("yoy_change")
def yoy_change(spark, sf_dir):
    return with_change(with_previous_year(ticker_year_totals(dim(spark, sf_dir))))


@query("fct_dividend_trends")
def fct_dividend_trends(spark, sf_dir):
    return trends(dim(spark, sf_dir))


@query("not_null_checks")
def not_null_checks(spark, sf_dir):
    return not_null_report(stg(spark, sf_dir))


@query("model_build")
def model_build(spark, sf_dir):
    """The models as stored tables and view; rows of each."""
    models = build_models(fx.raw_dividends(spark, sf_dir), database(spark), fx.AS_OF)
    return reduce(
        DataFrame.unionByName,
        [df.agg(F.lit(name).alias("relation"), F.count("*").alias("row_count")) for name, df in models.items()],
    )


@query("stored_summary")
def stored_summary(spark, sf_dir):
    """The rows of the summary as the stored view gives them."""
    return build_models(fx.raw_dividends(spark, sf_dir), database(spark), fx.AS_OF)["fct_dividend_summary"]


@query("stage_refresh")
def stage_refresh(spark, sf_dir):
    """The dimension built on one day and refreshed on a later one without new rows."""
    raw, name = fx.raw_dividends(spark, sf_dir), database(spark)
    refresh_models(raw, name, fx.AS_OF)
    return refresh_models(raw.where("false"), name, fx.LATER)["dim_dividends"].drop("loaded_at")


@query("model_refresh")
def model_refresh(spark, sf_dir):
    """The dimension after its rows came in two parts, the second merged without reading the first."""
    raw, name = fx.raw_dividends(spark, sf_dir), database(spark)
    refresh_models(fx.first_part(raw), name, fx.AS_OF)
    return refresh_models(fx.other_part(raw), name, fx.AS_OF)["dim_dividends"].drop("loaded_at")


@query("single_run")
def single_run(spark, sf_dir):
    """Pages to models in one run; the top changes as stored."""
    landing = scratch_dir(spark, "pages")
    fx.land_pages(fx.raw_dividends(spark, sf_dir), landing)
    models, _ = run_once(
        spark, landing, scratch_dir(spark, "run"), f"divtide_{uuid4().hex}", fx.AS_OF, csv_staging=True
    )
    return models["fct_dividend_trends"]


@query("trends_refresh")
def trends_refresh(spark, sf_dir):
    """The top changes after three batches, kept by differences of the changed rows."""
    name = database(spark)
    for part in fx.three_parts(fx.raw_dividends(spark, sf_dir)):
        models = refresh_models(part, name, fx.AS_OF)
    return models["fct_dividend_trends"]


@query("summary_refresh")
def summary_refresh(spark, sf_dir):
    """The rows of the stored summary after three batches, of which each computed its own groups anew."""
    name = database(spark)
    for part in fx.three_parts(fx.raw_dividends(spark, sf_dir)):
        models = refresh_models(part, name, fx.AS_OF)
    return models["fct_dividend_summary"]


@query("audited_build")
def audited_build(spark, sf_dir):
    """The dimension that readers see after a batch with missing values failed its audit: the one before."""
    raw, name = fx.raw_dividends(spark, sf_dir), database(spark)
    refresh_models(fx.complete_part(raw), name, fx.AS_OF, audit=True)
    try:
        refresh_models(fx.incomplete_part(raw), name, fx.AS_OF, audit=True)
    except AuditError:
        return spark.table(f"{name}.dim_dividends").drop("loaded_at")
    raise RuntimeError("rows without values passed the audit")
