"""Checks and counts, each in one pass."""

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from divtide.schema import NOT_NULL_COLUMNS

LEDGER = T.StructType(
    [
        T.StructField("batch", T.StringType()),
        *[T.StructField(c, T.LongType()) for c in ("pages", "rejected_pages", "rows", "stored_at")],
    ]
)


def not_null_report(df: DataFrame, columns: list[str] = NOT_NULL_COLUMNS) -> DataFrame:
    """`(column_name, failures)`: how many rows lack a value in each column."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "failures")


def batch_metrics(history: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows of the batch, and rows in the history before and after appending it."""
    sides = history.select(F.lit(False).alias("new")).union(batch.select(F.lit(True)))
    return sides.agg(
        F.count_if("new").alias("rows_in_batch"),
        F.count_if(~F.col("new")).alias("rows_before"),
        F.count("*").alias("rows_after"),
    )


def ledger_counts(spark: SparkSession, counts: dict) -> DataFrame:
    """The counts of a load as a row of the ledger; of two of a batch the one stored later holds."""
    stamped = {**counts, "stored_at": time.time_ns()}
    return spark.createDataFrame([tuple(stamped[c] for c in LEDGER.names)], LEDGER)


def current_counts(ledger: DataFrame) -> DataFrame:
    """A row for each batch: its counts when it was last stored."""
    last = F.max(F.struct("stored_at", *LEDGER.names[1:-1])).alias("last")
    return ledger.groupBy("batch").agg(last).select("batch", *[f"last.{c}" for c in LEDGER.names[1:-1]])


def ledger_totals(ledger: DataFrame, but: str | None = None) -> int:
    """Rows of the history by the ledger, without those of one batch: no history is read."""
    others = current_counts(ledger).where(~F.col("batch").eqNullSafe(F.lit(but)))
    return others.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
