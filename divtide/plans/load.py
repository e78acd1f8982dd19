"""Storing one batch of landed pages, shared by single runs and the stream."""

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from divtide.functions import blank_null_tokens
from divtide.operators.admission import admitted_pages, ok_pages, walk_stops
from divtide.operators.quality import LEDGER, ledger_counts, ledger_totals
from divtide.schema import CORRUPT_COLUMN
from divtide.session import kept_once
from divtide.sources.history import append_history, batch_folder, read_batch
from divtide.sources.pages import page_rows, rejected_pages
from divtide.sources.parts import PARTS, PartTable
from divtide.sources.row_index import index_batch, row_index, rows_not_held
from divtide.sources.staging_csv import clear_staging, read_staging, write_staging
from divtide.sources.warehouse import replace_batch

WALKS = T.StructType(
    [T.StructField("run", T.StringType()), T.StructField("stop", T.LongType()), T.StructField("batch", T.StringType())]
)


@dataclass(frozen=True)
class Targets:
    """Where a batch goes: folders for history and rejected pages, and the raw table.

    With a `staging` folder the table is loaded from staged CSV files, in which `null_tokens` count
    as missing; without one it is loaded from the history. With `only_new`, rows that the history
    already holds in every column are not stored again; an index of row hashes beside the history tells.
    With a `walks` folder, only pages that a walk along `next_url` reaches are loaded; where walks stop is
    kept there, so that a walk may land in several batches, its pages in order. With a `ledger` folder, the
    counts of every batch are kept there, and a load also returns the rows of the history before and after.
    `parts` is how many parts the index and the walks begin with: more, the less a batch touches of them.
    """

    history: str
    rejects: str
    table: str
    staging: str | None = None
    null_tokens: tuple[str, ...] = ("",)
    only_new: bool = False
    walks: str | None = None
    ledger: str | None = None
    parts: int = 16

    @property
    def index(self) -> str:
        return f"{self.history.rstrip('/')}_index"


def load_batch(pages: DataFrame, targets: Targets, batch_id: str) -> dict:
    """Stores a batch in every target and returns its counts.

    History, rejects and table keep the batch as a partition of its own and replace that on a
    repeat. A batch that failed half way can be done again whole and adds nothing twice. Pages whose
    request failed add no rows, whether they belong to a walk or not. The pages are parsed once for the
    history; what follows reads its new partition. Walks need a pass of their own over the fields that
    place a page, and rejected pages, where there are any, one more. With `only_new`, parsed rows are kept
    in scratch while they are compared. If loading the table fails, the staged files stay.
    """
    if not re.fullmatch(r"[\w.-]+", batch_id):
        raise ValueError(f"a batch id names a folder: {batch_id!r}")
    spark = pages.sparkSession
    read, stored = Observation(), Observation()
    corrupt = F.count_if(F.col(CORRUPT_COLUMN).isNotNull())
    seen = pages.observe(read, F.count(F.lit(1)).alias("pages"), corrupt.alias("rejected_pages"))
    if targets.walks:
        seen = admitted_pages(seen, stops_so_far(pages, targets.walks, batch_id, targets.parts))
    rows = page_rows(ok_pages(seen, "http_status"))
    if targets.only_new:
        index = row_index(spark, targets.index, targets.history, targets.parts)
        rows = rows_not_held(kept_once(rows, "batch"), index, targets.history, batch_id)
    append_history(rows.observe(stored, F.count(F.lit(1)).alias("rows")), targets.history, batch_id)
    if targets.only_new:
        index_batch(index, read_batch(spark, targets.history, batch_id), batch_id)
    counts = {"batch": batch_id, **read.get, **stored.get}
    store_rejects(pages, batch_folder(targets.rejects, batch_id), counts["rejected_pages"])

    rows = read_batch(spark, targets.history, batch_id)
    if targets.staging:
        # A folder for each batch, so that two loads at once do not meet.
        staging = batch_folder(targets.staging, batch_id)
        write_staging(rows, staging)
        rows = blank_null_tokens(read_staging(spark, staging), list(targets.null_tokens))
    replace_batch(rows, targets.table, batch_id)
    if targets.staging:
        clear_staging(spark, staging)
    if targets.ledger:
        # Last, so that only batches stored everywhere count.
        ledger = PartTable(spark, targets.ledger, LEDGER, ["batch"], parts=1)
        before = ledger_totals(ledger.read(), but=batch_id)
        ledger.append(ledger_counts(spark, counts))
        counts |= {"rows_before": before, "rows_after": before + counts["rows"]}
    return counts


def stops_so_far(pages: DataFrame, walks: str, batch_id: str, parts: int = PARTS) -> DataFrame:
    """Where the walks of these pages stop, by this batch and all others: a row for each of their runs.

    The folder holds a table in parts, dealt by run, with a row for each run that ended in a batch. Only parts
    of the batch's runs are read, and no folder of another batch is listed. If the batch was begun before, what
    it stored then goes first.
    """
    spark = pages.sparkSession
    table = PartTable(spark, walks, WALKS, ["run"], parts)
    mine = kept_once(walk_stops(pages), "walks")
    begun = f"{walks.rstrip('/')}/begun/{batch_id}"
    if table.files.exists(begun):
        earlier = table.read().where(F.col("batch") == batch_id)
        touched = table.touched(earlier)
        if touched:
            table.replace(table.read(touched).where(F.col("batch") != batch_id), touched)
    else:
        table.files.create(begun, "")
    table.append(mine.where("stop IS NOT NULL").withColumn("batch", F.lit(batch_id)))
    table.clean()
    runs = mine.select("run")
    known = table.read(table.touched(runs)).join(runs, "run", "left_semi")
    return known.groupBy("run").agg(F.min("stop").alias("stop"))


def store_rejects(pages: DataFrame, folder: str, expected: int) -> None:
    """Stores the rejected pages of a batch in place of those it stored before.

    Fails if they are not as many as were counted while loading, so that none is lost in silence.
    """
    rejects = rejected_pages(pages)
    if not expected:
        # Nothing to read again; an earlier try may have left some.
        pages.sparkSession.createDataFrame([], rejects.schema).write.mode("overwrite").json(folder)
        return
    written = Observation()
    rejects.observe(written, F.count(F.lit(1)).alias("n")).write.mode("overwrite").json(folder)
    if written.get["n"] != expected:
        raise RuntimeError(f"{expected} pages were rejected, but {written.get['n']} could be stored in {folder}")
