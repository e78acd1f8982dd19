"""Yearly totals, their change from year to year, and per-row group totals."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

GROUP_KEYS = ["ticker", "pay_year", "record_date"]
# Amounts are added as decimals, so that what was added can be taken away again without a trace. Amounts that
# a decimal does not give back exactly, and those of 10^9 and more, whose sums might not fit, count as odd.
AMOUNT = T.DecimalType(38, 18)
STATE_SUMS = ["amount", "n_amounts", "n_odd", "n_rows"]
TOTAL_STATE = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("amount", AMOUNT),
        *[T.StructField(c, T.LongType()) for c in STATE_SUMS[1:]],
    ]
)


def ticker_year_totals(dim: DataFrame) -> DataFrame:
    """Cash per ticker and pay year. NULL tickers and years form groups of their own."""
    return dim.groupBy("ticker", F.year("pay_date").alias("year")).agg(
        F.sum("cash_amount").alias("total_cashes")
    )


def with_previous_year(totals: DataFrame) -> DataFrame:
    """Adds the total of the ticker's previous year that has one.

    The window holds one row per year of a ticker, so no ticker can outgrow a task.
    """
    by_year = Window.partitionBy("ticker").orderBy(F.col("year").asc_nulls_last())
    return totals.withColumn("total_cashes_previous_year", F.lag("total_cashes").over(by_year))


def with_change(totals: DataFrame) -> DataFrame:
    """Adds the change against the previous year, which counts as zero where there is none."""
    previous = F.coalesce("total_cashes_previous_year", F.lit(0.0))
    return totals.withColumn("year_over_year_change", F.round(F.col("total_cashes") - previous, 2))


def top_changes(changes: DataFrame, n: int = 10) -> DataFrame:
    """The `n` largest changes, an unknown change counting as largest; ties by ticker and year."""
    return changes.orderBy(
        F.col("year_over_year_change").desc_nulls_first(),
        F.col("ticker").asc_nulls_last(),
        F.col("year").asc_nulls_last(),
    ).limit(n)


def total_state(rows: DataFrame, by: list[str] = ["ticker", "year"]) -> DataFrame:
    """Per ticker and pay year: the sum of amounts, how many there are, how many are odd, how many rows.

    Other columns to group `by` may be given: those of `rows`, and `year` and `pay_year`, which are the same.
    """
    cash = F.col("cash_amount")
    exact = F.when(F.abs(cash) < 1e9, cash.try_cast(AMOUNT))
    fits = F.coalesce(exact.cast("double") == cash, F.lit(False))
    return rows.withColumns({c: F.year("pay_date") for c in ("year", "pay_year")}).groupBy(by).agg(
        F.coalesce(F.sum(F.when(fits, exact)), F.lit(0)).cast(AMOUNT).alias("amount"),
        F.count("cash_amount").alias("n_amounts"),
        F.count_if(cash.isNotNull() & ~fits).alias("n_odd"),
        F.count("*").alias("n_rows"),
    )


def negated_state(state: DataFrame) -> DataFrame:
    return state.withColumns({c: (-F.col(c)).cast(TOTAL_STATE[c].dataType) for c in STATE_SUMS})


def merged_states(states: DataFrame, drop_unchanged: bool = False) -> DataFrame:
    """States of the same group added up; groups that no row is left in go.

    For a change rather than a state, `drop_unchanged` drops the groups in which nothing changes.
    """
    sums = {c: F.sum(c).cast(TOTAL_STATE[c].dataType).alias(c) for c in STATE_SUMS}
    merged = states.groupBy("ticker", "year").agg(*sums.values())
    if drop_unchanged:
        return merged.where(" OR ".join(f"{c} <> 0" for c in STATE_SUMS))
    return merged.where("n_rows > 0")


def state_totals(state: DataFrame) -> DataFrame:
    """The totals of groups without odd amounts; a group without any amount has none."""
    total = F.when(F.col("n_amounts") > 0, F.col("amount").cast("double"))
    return state.select("ticker", "year", total.alias("total_cashes"))


def group_keys(rows: DataFrame) -> DataFrame:
    return rows.withColumn("pay_year", F.year("pay_date"))


def dividend_groups(dim: DataFrame) -> DataFrame:
    """One row per (ticker, pay year, record date), with the number of its dividends and their totals."""
    return (
        group_keys(dim)
        .groupBy(GROUP_KEYS)
        .agg(
            F.count("*").alias("n"),
            F.sum("cash_amount").alias("total_dividend_amount_of_year"),
            F.avg("cash_amount").alias("average_dividend_amount_of_year"),
            F.max("pay_date").alias("last_pay_date_of_year"),
            F.min("pay_date").alias("first_pay_date_of_year"),
        )
    )
