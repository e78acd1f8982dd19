"""A uniform shuffle of any size into equal shards, in two passes.

Pass 1 gives each record a seeded hash and writes it; the hash scatters records uniformly over buckets that fit
in memory. Pass 2 puts each bucket into Fisher-Yates order (Spark's `shuffle`) and lays the buckets end to end.
Shards are even stretches of that order, so the counts of any two differ by at most one, and a task that holds a
bucket writes it to one or two shards without another shuffle.

The hash covers a row number besides the content. A bucket therefore stays small if a third of all rows share
one id or are the same row; the order is fixed by the seed and the layout of the input files.

Defined cases: a NULL text has no bytes, so its size is 16 and its checksum that of the empty text. A NULL
doc_id is a value like any other. Repeated rows each get a slot. An empty table gives no rows. Whole records
travel (or doc_id, text and the columns named in `payload`), inside a struct, so their names cannot clash with
those made here. Size and checksum are those of the text that arrived.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from divtide.llm.common import stored, whole_text
from divtide.session import scratch_dir

LAW = "rows"
ROW_BYTES = 16  # what a row takes besides its text
BUCKET_BYTES = 32 << 20  # of rows that one task holds at a time
MIN_BUCKETS = 64
# Bucket counts are summed in blocks of this many, so no task reads them all.
BLOCK = 1024


def digests(text: Column | str) -> tuple[Column, Column]:
    """size and text_crc32 of a text."""
    text = whole_text(text)
    return (F.octet_length(text).cast("long") + ROW_BYTES).alias("size"), F.crc32(text).alias("text_crc32")


def scatter(docs: DataFrame, payload: tuple[str, ...] | None = None, seed: int = 17) -> DataFrame:
    """Pass 1, written: the seeded hash `spread`, size, and `record` with all columns or those of the payload."""
    names = dict.fromkeys(docs.columns if payload is None else ("doc_id", "text", *payload))
    record = F.struct(*[F.col(f"`{c}`") for c in names])
    spread = F.xxhash64(F.lit(seed), F.col("record.doc_id"), "size", "text_crc32", F.monotonically_increasing_id())
    rows = docs.select(*digests("text"), record.alias("record"))
    return stored(rows.select(spread.alias("spread"), "size", "record"), "scattered", compression="zstd")


def bucket_offsets(rows: DataFrame) -> DataFrame:
    """bucket and the number of rows in all buckets before it."""
    counts = rows.groupBy("bucket").agg(F.count("*").alias("n"))
    counts = counts.withColumn("block", F.floor(F.col("bucket") / BLOCK))
    blocks = counts.groupBy("block").agg(F.sum("n").alias("block_n"))
    before = F.sum("block_n").over(W.orderBy("block")) - F.col("block_n")
    blocks = blocks.select("block", before.alias("before"))
    inside = F.sum("n").over(W.partitionBy("block").orderBy("bucket")) - F.col("n")
    return (
        counts.withColumn("inside", inside)
        .join(blocks, "block")
        .select("bucket", (F.col("before") + F.col("inside")).alias("offset"))
    )


def external_shuffle(
    docs: DataFrame,
    n_shards: int,
    payload: tuple[str, ...] | None = None,
    seed: int = 17,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, record, law, shard, slot, grown_shard."""
    scattered = scatter(docs, payload, seed)
    total = scattered.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("size"), F.count("*").alias("n")).first()
    n_buckets = max(MIN_BUCKETS, -(-total["size"] // bucket_bytes))
    rows = scattered.withColumn("bucket", F.pmod("spread", F.lit(n_buckets)))
    # Sorted first, so that what arrives in another order is shuffled alike.
    held = F.sort_array(F.collect_list(F.struct("spread", "record")))
    # Dealt before they are collected, so that no task holds the texts of its whole input.
    buckets = rows.repartition(n_buckets, "bucket").groupBy("bucket").agg(held.alias("held"))
    order = buckets.join(bucket_offsets(rows), "bucket").select(
        "offset", F.posexplode(F.shuffle("held", F.lit(seed))).alias("at", "row")
    )
    place = F.col("offset") + F.col("at")
    # The first `longer` shards have one row more than the others.
    least, longer = divmod(total["n"], n_shards)
    split = longer * (least + 1)
    rest = place - split
    shard = F.when(place < split, F.floor(place / (least + 1))).otherwise(longer + F.floor(rest / max(1, least)))
    slot = F.when(place < split, place % (least + 1)).otherwise(rest % max(1, least))
    return order.select(
        "row.record.doc_id",
        *digests("row.record.text"),
        "row.record",
        F.lit(LAW).alias("law"),
        shard.cast("int").alias("shard"),
        slot.cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(placed: DataFrame, path: str, rows_per_file: int = 100_000) -> None:
    """Writes the records, one folder per shard, each file in slot order and of bounded length."""
    named = placed.select("record.*", F.struct("shard", "slot").alias("placed"), F.col("shard").alias("_shard"))
    ordered = named.sortWithinPartitions("_shard", "placed.slot")
    ordered.write.option("maxRecordsPerFile", rows_per_file).partitionBy("_shard").parquet(path)


def stored_shards(placed: DataFrame) -> DataFrame:
    """The shards written below `spark.checkpoint.dir`, and what lies there: all columns but the record."""
    path = scratch_dir(placed.sparkSession, "shards")
    write_shards(placed, path)
    fields = [placed.schema["record"].dataType["doc_id"], placed.schema["record"].dataType["text"]]
    at = T.StructType([placed.schema["shard"], placed.schema["slot"]])
    written = placed.sparkSession.read.schema(T.StructType([*fields, T.StructField("placed", at)])).parquet(path)
    return written.select(
        "doc_id",
        *digests("text"),
        F.lit(LAW).alias("law"),
        "placed.shard",
        "placed.slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
