"""The four models, each a function of the relation it reads."""

import datetime as dt
from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from divtide.functions import as_date, as_double, as_long, clean_text, day, frequency_label, lifecycle_stage
from divtide.operators.dedup import drop_null_keys, keep_latest
from divtide.operators.normalize import conform, null_safe_semi
from divtide.operators.totals import (
    GROUP_KEYS,
    STATE_SUMS,
    TOTAL_STATE,
    dividend_groups,
    merged_states,
    negated_state,
    state_totals,
    ticker_year_totals,
    top_changes,
    total_state,
    with_change,
    with_previous_year,
)
from divtide.schema import NOT_NULL_COLUMNS, RAW_SCHEMA
from divtide.session import kept_once, shuffle_partitions
from divtide.sources.pages import no_rows
from divtide.sources.parts import BUILD_SECONDS, PARTS, PartTable
from divtide.sources.warehouse import read_raw, replace_table

# Column order of the dimension.
DIM_COLUMNS = [
    "dividend_id",
    "ticker",
    "ex_dividend_date",
    "pay_date",
    "record_date",
    "declaration_date",
    "dividend_type",
    "frequency",
    "dividend_frequency",
    "cash_amount",
    "currency",
    "dividend_lifecycle_stage",
    "loaded_at",
]

Day = dt.date | str | Column | None


def clean_columns(latest: DataFrame) -> DataFrame:
    """Raw text columns renamed, cleaned and cast; what cannot be cast becomes NULL."""
    return latest.select(
        F.col("id").alias("dividend_id"),
        clean_text(F.col("ticker")).alias("ticker"),
        *[
            as_date(F.col(c)).alias(c)
            for c in ("ex_dividend_date", "pay_date", "record_date", "declaration_date")
        ],
        "dividend_type",
        as_long(F.col("frequency")).alias("frequency"),
        as_double(F.col("cash_amount")).alias("cash_amount"),
        clean_text(F.col("currency")).alias("currency"),
    )


def staged(latest: DataFrame, as_of: Day = None, loaded_at: Column | None = None) -> DataFrame:
    """The latest raw rows typed, with their lifecycle stage on the day `as_of`."""
    stamp = F.current_timestamp() if loaded_at is None else loaded_at
    typed = clean_columns(latest).withColumn("loaded_at", stamp)
    return typed.withColumn("dividend_lifecycle_stage", lifecycle_stage(as_of))


def staging(raw: DataFrame, as_of: Day = None, loaded_at: Column | None = None) -> DataFrame:
    """One typed row per dividend, from the latest of its raw rows."""
    return staged(keep_latest(drop_null_keys(raw)), as_of, loaded_at)


def dimension(stg: DataFrame) -> DataFrame:
    return stg.withColumn("dividend_frequency", frequency_label(F.col("frequency"))).select(DIM_COLUMNS)


# Groups are cut into chunks of at most so many rows, and chunks are dealt to tasks: a group is a few bytes
# however many rows it stands for, so tasks must not be sized by the bytes of groups.
CHUNK_ROWS = 4_096
# Rows that a task of the stored view puts out, on average.
ROWS_PER_TASK = 1_000_000
# Raw rows for which a rebuild gives the model tables a part more.
ROWS_PER_PART = 1_000_000


def expanded_sql(groups: str, partitions: int, chunk_rows: int = CHUNK_ROWS) -> str:
    """The totals in `groups` once for each of their `n` rows.

    Groups are cut into chunks that are dealt to `partitions` tasks, and repeated there.
    """
    return f"""
    WITH chunks AS (
      SELECT /*+ REPARTITION({partitions}, ticker, pay_year, record_date, chunk) */ *
      FROM (SELECT *, explode(sequence(0, (n - 1) div {chunk_rows})) AS chunk FROM {groups})
    ), repeated AS (
      SELECT *, explode(sequence(1, least({chunk_rows}, n - chunk * {chunk_rows}))) AS copy FROM chunks
    )
    SELECT ticker, total_dividend_amount_of_year, average_dividend_amount_of_year,
      last_pay_date_of_year, first_pay_date_of_year
    FROM repeated
    """


def summary(dim: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Group totals on every dividend. The columns say "of year", the groups also split by record date.

    The result has group-level columns only, so instead of a window, which would sort a whole group
    in one task, the groups are aggregated (combined before the shuffle) and repeated once per row.
    """
    spark = dim.sparkSession
    return spark.sql(expanded_sql("{groups}", shuffle_partitions(spark), chunk_rows), groups=dividend_groups(dim))


def trends(dim: DataFrame, n: int = 10) -> DataFrame:
    """The `n` largest changes of a ticker's yearly cash."""
    return top_trends(ticker_year_totals(dim), n)


def top_trends(totals: DataFrame, n: int = 10) -> DataFrame:
    changes = with_change(with_previous_year(totals))
    columns = ("total_cashes_previous_year", "year_over_year_change")
    return top_changes(
        changes.select("ticker", "year", F.col("total_cashes").alias("total_cashes_current_year"), *columns), n
    )


def day_of(spark: SparkSession, as_of: Day) -> str:
    """The day as text, one for all that a refresh writes."""
    return str(spark.range(1).select(day(as_of).cast("string")).first()[0])


class AuditError(RuntimeError):
    """A build whose checks failed; readers still see the one before."""

    def __init__(self, failures: dict[str, int]):
        super().__init__(f"not published, values are missing: {failures}")
        self.failures = failures


class ModelTables:
    """The model tables of a database, in parts, each derived from a build of the one before it.

    Every build notes the build it was made from, so a refresh that failed half way is taken up by the next
    one, whatever rows that brings. Readers see what `publish` made current.
    """

    def __init__(self, spark: SparkSession, database: str):
        self.spark, self.database = spark, database
        root = spark.catalog.getDatabase(database).locationUri
        no_stg = staged(no_rows(spark), "2000-01-01")
        self.changes: dict[tuple[int, int], DataFrame] = {}

        def table(name: str, schema: T.StructType, keys: list[str]) -> PartTable:
            return PartTable(spark, f"{root}/{name}", schema, keys)

        self.latest = table("dividends_latest", RAW_SCHEMA, ["id"])
        self.stg = table("stg_stock_dividends", no_stg.schema, ["dividend_id"])
        self.dim = table("dim_dividends", dimension(no_stg).schema, ["dividend_id"])
        self.totals = table("ticker_year_totals", TOTAL_STATE, ["ticker"])
        self.groups = table("dividend_groups", dividend_groups(dimension(no_stg)).schema, GROUP_KEYS)
        # An id lies in the same part of each of these.
        self.stg.deal(self.latest.parts)
        self.dim.deal(self.latest.parts)

    def merge(self, rows: DataFrame, all_rows: bool = False) -> None:
        """Brings the latest row of each id up to date, writing only parts that have ids of `rows`.

        The ids are kept with the build, for tables that are refreshed by differences. With `all_rows`, the
        given rows are all there are, and their number decides how many parts the tables have.
        """
        if all_rows:
            parts = max(PARTS, -(-rows.count() // ROWS_PER_PART))
            for table in (self.latest, self.stg, self.dim, self.totals, self.groups):
                table.deal(parts)
            self.latest.replace(keep_latest(rows))
            return
        ids = f"{self.latest.root}/ids/{uuid4().hex}"
        rows.select("id").distinct().write.parquet(ids)
        touched = self.latest.touched(self.spark.read.schema("id string").parquet(ids))
        held = self.latest.read(touched)
        self.latest.replace(keep_latest(held.unionByName(rows)), touched, {"ids": ids})

    def refresh_rows(self, as_of: str) -> None:
        """Staging and dimension, of the parts whose latest rows or whose stages on that day are others."""
        source, before = self.latest.build(), self.stg.build()
        notes = before.notes if before else {}
        parts = set(source.changed(self.latest.build(notes.get("source", 0))))
        if before and notes.get("day") != as_of:
            moved = self.stg.read().where(~F.col("dividend_lifecycle_stage").eqNullSafe(lifecycle_stage(as_of)))
            parts |= set(self.stg.touched(moved))
        parts = sorted(parts)
        # Rows that lack a value are known of the parts that stay; others are counted as they were written.
        known = {p: n for p, n in notes.get("failures", {}).items() if int(p) not in parts}
        notes = {"source": source.number, "day": as_of, "failures": known}
        self.stg.replace(staged(self.latest.read(parts), as_of), parts, notes, in_parts=True)
        unknown = [p for p in range(self.stg.parts) if str(p) not in known]
        failures = {str(p): dict.fromkeys(NOT_NULL_COLUMNS, 0) for p in unknown}
        if unknown:
            lacking = [F.count_if(F.col(c).isNull()).alias(c) for c in NOT_NULL_COLUMNS]
            for row in self.stg.read(unknown).groupBy(self.stg.part().alias("part")).agg(*lacking).collect():
                failures[str(row["part"])] = {c: row[c] for c in NOT_NULL_COLUMNS}
        build = self.stg.replace(no_rows(self.spark), [], {**notes, "failures": known | failures})

        before = self.dim.build()
        parts = build.changed(self.stg.build(before.notes["source"]) if before else None)
        self.dim.replace(dimension(self.stg.read(parts)), parts, {"source": build.number}, in_parts=True)

    def failures(self) -> dict[str, int]:
        """How many rows of the newest staging build lack a value in each column that must have one."""
        known = self.stg.build().notes["failures"].values()
        return {c: sum(n[c] for n in known) for c in NOT_NULL_COLUMNS}

    def changed_groups(self, since: int) -> DataFrame | None:
        """What the latest rows of all ids merged since a build brought then, negated, and what they bring now.

        States by group of the summary, for each group that one of these rows was or is in. They are computed
        once, for totals and groups. None where that is not known: the build is gone, or all rows were replaced
        since.
        """
        now, then = self.latest.build(), self.latest.build(since)
        builds = [self.latest.build(n) for n in range(since + 1, now.number + 1)]
        if then is None or not all(b and b.notes.get("ids") for b in builds):
            return None
        if not builds:
            return total_state(clean_columns(no_rows(self.spark)), GROUP_KEYS)
        if (since, now.number) in self.changes:
            return self.changes[since, now.number]
        ids = self.spark.read.schema("id string").parquet(*[b.notes["ids"] for b in builds]).distinct()
        parts = now.changed(then)
        old, new = (self.latest.read(parts, b).join(ids, "id", "left_semi") for b in (then, now))
        old, new = (total_state(clean_columns(rows), GROUP_KEYS) for rows in (old, new))
        self.changes[since, now.number] = kept_once(negated_state(old).unionByName(new), "change")
        return self.changes[since, now.number]

    def refresh_totals(self) -> None:
        """Yearly totals: what changed rows brought before leaves its group, what they bring now enters."""
        now, before = self.latest.build().number, self.totals.build()
        changed = self.changed_groups(before.notes["source"]) if before else None
        if changed is None:
            self.totals.replace(total_state(clean_columns(self.latest.read())), notes={"source": now})
            return
        states = changed.select("ticker", F.col("pay_year").alias("year"), *STATE_SUMS)
        change = kept_once(merged_states(states, drop_unchanged=True), "change")
        touched = self.totals.touched(change)
        merged = merged_states(self.totals.read(touched).unionByName(change)) if touched else change
        self.totals.replace(merged, touched, {"source": now})

    def refresh_groups(self) -> None:
        """Groups of the summary: those that a changed row was or is in are computed anew, from their rows only."""
        now, before = self.latest.build().number, self.groups.build()
        rows = self.dim.read()
        changed = self.changed_groups(before.notes["source"]) if before else None
        if changed is None:
            self.groups.replace(dividend_groups(rows), notes={"source": now})
            return
        keys = kept_once(changed.select(GROUP_KEYS).distinct(), "groups")
        touched = self.groups.touched(keys)
        # Spark filters the rows by keys that it can broadcast; with more, groups are joined and not rows.
        again = null_safe_semi(dividend_groups(rows), keys, GROUP_KEYS)
        others = null_safe_semi(self.groups.read(touched), keys, GROUP_KEYS, anti=True) if touched else again
        self.groups.replace(others.unionByName(again), touched, {"source": now})

    def publish(self) -> dict[str, DataFrame]:
        """Points readers at the newest builds: tables of staging, dimension and trends, the summary as a view."""
        spark, database = self.spark, self.database
        stg = self.stg.publish(f"{database}.stg_stock_dividends")
        dim = self.dim.publish(f"{database}.dim_dividends")
        self.groups.publish(f"{database}.dividend_groups")
        # As many tasks as the view has rows to put out, counted for each build (from the files' footers).
        partitions = max(shuffle_partitions(spark), -(-dim.count() // ROWS_PER_TASK))
        view = f"{database}.fct_dividend_summary"
        spark.sql(f"CREATE OR REPLACE VIEW {view} AS {expanded_sql(f'{database}.dividend_groups', partitions)}")
        top = replace_table(top_trends(self.ticker_years()), f"{database}.fct_dividend_trends")
        self.clean()
        return {
            "stg_stock_dividends": stg,
            "dim_dividends": dim,
            "fct_dividend_summary": spark.table(view),
            "fct_dividend_trends": top,
        }

    def clean(self, seconds: float = BUILD_SECONDS) -> None:
        """Removes builds that were replaced longer ago, and the ids kept with them."""
        for table in (self.latest, self.stg, self.dim, self.totals, self.groups):
            table.clean(seconds)
        ids, files = f"{self.latest.root}/ids", self.latest.files
        named = {(self.latest.build(n).notes.get("ids") or "").rsplit("/", 1)[-1] for n in self.latest.numbers()}
        for name, age in files.names(ids).items():
            if age > seconds and name not in named:
                files.delete(f"{ids}/{name}")

    def ticker_years(self) -> DataFrame:
        """Yearly totals; groups with an amount that no decimal holds are summed from their rows."""
        state = self.totals.read()
        known = state_totals(state.where("n_odd = 0"))
        odd = state.where("n_odd > 0").select("ticker", "year")
        if odd.isEmpty():
            return known
        rows = self.dim.read().withColumn("year", F.year("pay_date"))
        return known.unionByName(ticker_year_totals(null_safe_semi(rows, odd, ["ticker", "year"])))


def refreshed(tables: ModelTables, as_of: Day, audit: bool) -> dict[str, DataFrame]:
    """All models from the latest rows: written, checked with `audit`, then published."""
    tables.refresh_rows(day_of(tables.spark, as_of))
    if audit and any(tables.failures().values()):
        raise AuditError({c: n for c, n in tables.failures().items() if n})
    tables.refresh_totals()
    tables.refresh_groups()
    return tables.publish()


def build_models(raw: DataFrame, database: str, as_of: Day = None, audit: bool = False) -> dict[str, DataFrame]:
    """Rebuilds every model from all raw rows.

    With `audit`, rows that lack a value they must have fail the build with `AuditError` before any reader
    sees it.
    """
    tables = ModelTables(raw.sparkSession, database)
    tables.merge(drop_null_keys(conform(raw)), all_rows=True)
    return refreshed(tables, as_of, audit)


def refresh_models(new: DataFrame, database: str, as_of: Day = None, audit: bool = False) -> dict[str, DataFrame]:
    """Brings the models up to date with `new` raw rows, without reading the older ones.

    A table of the latest raw row per id stands for all rows merged so far. Keeping the latest is a
    maximum, so the order of merging does not matter and merging rows again changes nothing. Each table
    is kept in parts, of which only those with ids of the new rows (or, on another day, with rows whose
    stage moves) are written; totals and groups follow from the changed rows.
    """
    tables = ModelTables(new.sparkSession, database)
    tables.merge(drop_null_keys(conform(new)))
    return refreshed(tables, as_of, audit)


def refresh_after(
    table: str, database: str, as_of: Day = None, audit: bool = False
) -> Callable[[SparkSession, dict], None]:
    """For a stream: brings the models up to date after each batch, whether it brought rows or not.

    The first time, all rows of the raw table are merged, so none loaded otherwise is missed; then
    only those of the batch. A batch without rows still moves the lifecycle stages to its day. Run
    one such stream per table.
    """
    merged_all = False

    def refresh(spark: SparkSession, counts: dict) -> None:
        nonlocal merged_all
        refresh_models(read_raw(spark, table, counts["batch"] if merged_all else None), database, as_of, audit)
        merged_all = True

    return refresh
