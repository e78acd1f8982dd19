"""Which landed pages count."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The first page of a run and up to four that follow it.
MAX_PAGES = 5


def ok_pages(log: DataFrame, status: str = "status") -> DataFrame:
    """Pages whose request did not fail; one that does not say how it ended counts as good."""
    return log.where(F.col(status).isNull() | (F.col(status) < 400))


def admit_pages(
    log: DataFrame, run: str = "run", order: str = "seq", max_pages: int = MAX_PAGES
) -> DataFrame:
    """The pages of each run that a walk along `next_url` would load, with their position `seq`.

    The walk ends at `max_pages`, after a page without `next_url`, or before the first failed page.
    Only the first pages of a run decide, so each run is cut to them before the shuffle
    (WindowGroupLimit) and a run with very many pages costs no more than another.
    """
    chain = Window.partitionBy(run).orderBy(order)
    so_far = chain.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first_pages = log.withColumn("page_no", F.row_number().over(chain)).where(F.col("page_no") <= max_pages)

    first = F.col("page_no") == 1
    good = F.when(first, F.col("status") < 400).otherwise(F.col("status").between(200, 299))
    linked = F.when(first, True).otherwise(F.lag(F.coalesce("next_url", F.lit("")) != "").over(chain))
    reached = F.coalesce(good, F.lit(False)) & linked
    return (
        first_pages.withColumn("reached", reached)
        .withColumn("admitted", F.min("reached").over(so_far))
        .where("admitted")
        .withColumn("seq", F.col("page_no") - 1)
        .select(log.columns if "seq" in log.columns else [*log.columns, "seq"])
    )


def walk_stops(pages: DataFrame) -> DataFrame:
    """`run` and `stop`, the first place that a walk of any length does not load; NULL for a run that goes on.

    A walk ends before a failed page and after a page without `next_url`. Both are minima, so pages are combined
    before the shuffle, runs of any length cost alike, and the stops of parts of a run combine by another minimum.
    """
    good = F.when(F.col("seq") == 0, F.col("http_status") < 400).otherwise(F.col("http_status").between(200, 299))
    failed = F.when(~F.coalesce(good, F.lit(False)), F.col("seq"))
    last = F.when(F.coalesce("next_url", F.lit("")) == "", F.col("seq") + 1)
    return pages.where("run IS NOT NULL").groupBy("run").agg(F.least(F.min(failed), F.min(last)).alias("stop"))


def admitted_pages(pages: DataFrame, stops: DataFrame) -> DataFrame:
    """Pages before the stop of their run, a row of `stops` for each; those of no run count as admitted, those of
    no place in one do not.

    `stops` should hold the runs of these pages only. Spark broadcasts it if it is small when measured, and then
    pages stay where they are. Where it does not, pages of no run, which may be all, are dealt out one by one:
    as a join key NULL would bring them all to one task.
    """
    loose = F.coalesce(F.when(F.col("run").isNull(), F.monotonically_increasing_id()), F.lit(-1).cast("long"))
    # One key of two fields: Spark would take a second key that is constant for stops out of the shuffle.
    dealt = pages.withColumn("walk", F.struct("run", loose.alias("loose")))
    known = stops.select(F.struct("run", F.lit(-1).cast("long").alias("loose")).alias("walk"), "stop")
    joined = dealt.join(known, "walk", "left")
    return joined.where("run IS NULL OR (seq IS NOT NULL AND (stop IS NULL OR seq < stop))").select(pages.columns)
