"""An index of row hashes, by which a batch finds the rows that the history holds without reading all of it.

The index is a table in parts dealt by the hash: a row for each distinct row hash of a batch. A batch reads the
parts of its own hashes only, eight bytes and a batch id a row. Where a hash is found, the rows of the batches
named there are read and compared in all ten columns, so hashes that agree by chance, or entries that a
repeated batch left behind, decide nothing.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from divtide.operators.normalize import conform
from divtide.schema import BATCH_COLUMN, RAW_COLUMNS
from divtide.sources.history import batches, new_rows, read_batches
from divtide.sources.parts import PARTS, PartTable

SCHEMA = T.StructType([T.StructField("row_hash", T.LongType()), T.StructField("batch", T.StringType())])


def row_hash() -> Column:
    """A hash of all ten columns that tells a missing value from an empty one, and where it is missing."""
    return F.xxhash64(*[F.coalesce(F.col(c), F.lit("\0")) for c in RAW_COLUMNS])


def row_index(spark: SparkSession, root: str, history: str, parts: int = PARTS) -> PartTable:
    """The index below `root`; if there is none yet, it is made from what the history holds."""
    index = PartTable(spark, root, SCHEMA, ["row_hash"], parts)
    if index.build() is None:
        held = batches(spark, history)
        index.append(held.select(row_hash().alias("row_hash"), F.col(BATCH_COLUMN).alias("batch")).distinct())
    return index


def index_batch(index: PartTable, rows: DataFrame, batch_id: str) -> None:
    """Adds the rows that a batch stored; adding them again does no harm."""
    index.append(rows.select(row_hash().alias("row_hash")).distinct().withColumn("batch", F.lit(batch_id)))


def rows_not_held(rows: DataFrame, index: PartTable, history: str, batch_id: str) -> DataFrame:
    """Rows that no other batch of the history holds, each once; NULLs compare as equal.

    `rows` are read several times: give rows that are stored. Their hashes alone are joined with the index and
    with the rows of the batches found there; Spark broadcasts those of a batch that is small when measured, so
    that neither is shuffled, and joins by shuffle beyond that. The rows themselves are shuffled once, grouped
    with the rows they may equal, and copies collapse before that.
    """
    spark = rows.sparkSession
    hashes = conform(rows).select(row_hash().alias("row_hash"))
    entries = index.read(index.touched(hashes))
    found = entries.where(F.col("batch") != batch_id).join(hashes, "row_hash", "left_semi")
    named = [r["batch"] for r in found.select("batch").distinct().collect()]  # names of folders that are read next
    if not named:
        return conform(rows).distinct()
    held = read_batches(spark, history, sorted(named)).withColumn("row_hash", row_hash())
    return new_rows(rows, held.join(hashes, "row_hash", "left_semi"))
