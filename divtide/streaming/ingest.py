"""Landed pages into history and raw table, as a Structured Streaming query."""

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from divtide.plans.load import Targets, load_batch
from divtide.schema import PAGE_SCHEMA
from divtide.sources.warehouse import create_raw_table

log = logging.getLogger(__name__)

# Fixed value: how often to look for pages.
INTERVAL = "5 minutes"

AfterBatch = Callable[[SparkSession, dict], None]


def page_stream(
    spark: SparkSession,
    landing: str,
    max_files: int | None = None,
    multi_line: bool = False,
    source_options: dict[str, str] | None = None,
) -> DataFrame:
    reader = spark.readStream.schema(PAGE_SCHEMA).options(multiLine=multi_line, **(source_options or {}))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(landing)


def start_ingest(
    spark: SparkSession,
    landing: str,
    targets: Targets,
    checkpoint: str,
    max_files: int | None = None,
    interval: str | None = INTERVAL,
    after_batch: AfterBatch | None = None,
    multi_line: bool = False,
    source_options: dict[str, str] | None = None,
) -> StreamingQuery:
    """Starts loading pages as they land in the folder `landing`.

    Without `interval` the stream takes what is there and ends. A batch takes all that has landed;
    `max_files` limits how many files it takes, and the others wait for the next. `after_batch` gets the session and the counts
    once a batch is stored, for example `refresh_after` of the models. `source_options` go to Spark's
    file source, for example `cleanSource` to move loaded pages away and keep the listing short.
    """
    create_raw_table(spark, targets.table, by_batch=True)

    def load(pages: DataFrame, number: int) -> None:
        session = pages.sparkSession
        # The query id comes from the checkpoint: another checkpoint cannot replace these batches.
        stream = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        counts = load_batch(pages, targets, f"{stream}-{number:08d}")
        log.info("stored %s", counts)
        if after_batch:
            after_batch(session, counts)

    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        page_stream(spark, landing, max_files, multi_line, source_options)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def ingest_available(spark: SparkSession, landing: str, targets: Targets, checkpoint: str, **options) -> None:
    """Loads the pages that have landed and were not loaded before."""
    start_ingest(spark, landing, targets, checkpoint, interval=None, **options).awaitTermination()
