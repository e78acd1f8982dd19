"""Finds short test items inside long documents by containment of their five-word shingles.

Items are partitioned by size. An item's MinHash sketch is its k smallest shingle fingerprints, with k set for
the largest item of its partition so that a document holding the wanted share of the item's shingles must
hold at least one of the sketch: of n shingles at most n - ceil(t n) may be missing, and k exceeds that. The
search thus has no false negatives, however long the document. Candidates are verified by counting the item's
shingles in the document exactly.

Documents are read once. A bitmap of fixed size over the sketches is sent to the workers; only shingles it
marks leave a worker, so no shuffle grows with the corpus unless the corpus is contaminated. A full bitmap
would let more through, never less.

Items of one to four words have one shingle of as many words, and documents are searched for shingles of these
lengths too, where there are such items.

Text is compared in lower case. Defined cases: items without words, and NULL or empty texts, match nothing. NULL ids are carried. A repeated document row is
matched once for each row, a repeated item once for each item row. Other columns of either table are not read.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from divtide.llm.bitmap import bitmap, marked, opened
from divtide.llm.common import stored, whole_text
from divtide.llm.shingles import SIZE, shingle_runs

THRESHOLD = 0.8


def partition_of(n: int) -> int:
    """Sizes 1, 2 to 3, 4 to 7 and so on."""
    return n.bit_length() - 1


def sketch_size(partition: int, threshold: float) -> int:
    """Enough smallest fingerprints for any item of the partition: one more than may be missing."""
    largest = (2 << partition) - 1
    return largest - int(np.ceil(threshold * largest - 1e-9)) + 1


def item_shingles(texts: list[str]) -> Iterator[tuple[int, int, np.ndarray]]:
    """Place, shingle length and distinct shingles of each text that has words."""
    # UTF-8 splits at just the six white-space codes.
    sizes = [min(SIZE, len(x.encode("utf-8", "surrogatepass").split())) for x in texts]
    for size in range(1, SIZE + 1):
        places = [i for i, n in enumerate(sizes) if n == size]
        for first, out, starts in shingle_runs([texts[i] for i in places], size):
            for i in range(len(starts) - 1):
                yield places[first + i], size, np.unique(out[starts[i] : starts[i + 1]])


ITEM_SCHEMA = "item_id long, size int, size_partition int, sketch array<long>, shingles array<long>"


def item_index(items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per searchable item: its size partition, sketch and shingles, numbered by `item`."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x.lower() for x in batch.column(1).to_pylist()]
            rows, sizes, parts, sketches, all_shingles = [], [], [], [], []
            for place, size, found in item_shingles(texts):
                part = partition_of(len(found))
                rows.append(place)
                sizes.append(size)
                parts.append(part)
                sketches.append(found[: sketch_size(part, threshold)].view(np.int64))
                all_shingles.append(found.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(sizes, pa.int32()),
                    pa.array(parts, pa.int32()),
                    pa.array(sketches, pa.list_(pa.int64())),
                    pa.array(all_shingles, pa.list_(pa.int64())),
                ],
                names=["item_id", "size", "size_partition", "sketch", "shingles"],
            )

    read = items.select(F.col("item_id").cast("long").alias("item_id"), whole_text("text").alias("text"))
    return read.mapInArrow(sketch, ITEM_SCHEMA).withColumn("item", F.monotonically_increasing_id())


HIT_SCHEMA = "doc_id long, doc_key binary, hits array<long>"


def contained(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each document row and item it holds: doc_id, doc_key, item_id, n_shingles, n_shared, containment.

    `doc_key` is the MD5 of the text.
    """
    spark = docs.sparkSession
    index = stored(item_index(items, threshold), "items")
    sketches = index.select("item", F.explode("sketch").alias("print"))
    every = index.select(F.explode("shingles").alias("print"))
    shared = spark.sparkContext.broadcast((bitmap(sketches), bitmap(every)))
    sizes = sorted(r["size"] for r in index.select("size").distinct().collect())

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, rest = map(opened, shared.value)
        for batch in batches:
            texts = [x.lower() for x in batch.column(2).to_pylist()]
            rows, hits = [], []
            # An item has shingles of one length, so each length can have rows of its own.
            for start, out, starts in (run for size in sizes for run in shingle_runs(texts, size)):
                owners = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
                keep = marked(rest, out)
                out, owners = out[keep], owners[keep]
                found = np.unique(owners[marked(first, out)])
                for i, low, high in zip(found, np.searchsorted(owners, found), np.searchsorted(owners, found, "right")):
                    rows.append(start + i)
                    hits.append(np.unique(out[low:high]).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    batch.column(1).take(pa.array(rows, pa.int64())),
                    pa.array(hits, pa.list_(pa.int64())),
                ],
                names=["doc_id", "doc_key", "hits"],
            )

    text = whole_text("text")
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.md5(text)).alias("doc_key"), text.alias("text"))
    hit = stored(read.mapInArrow(probe, HIT_SCHEMA).withColumn("row", F.monotonically_increasing_id()), "hits")
    pairs = hit.select("row", F.explode("hits").alias("print")).join(sketches, "print").select("row", "item").distinct()
    n, both = F.size("shingles").cast("long"), F.size(F.array_intersect("hits", "shingles")).cast("long")
    return (
        pairs.join(index, "item")
        .join(hit, "row")
        .select("doc_id", "doc_key", "item_id", n.alias("n_shingles"), both.alias("n_shared"))
        .withColumn("containment", F.round(F.col("n_shared") / F.col("n_shingles"), 6))
        .where(F.col("n_shared") >= F.ceil(F.lit(threshold) * F.col("n_shingles") - 1e-9))
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that hold no item, all their columns. The verdict depends on the text alone."""
    bad = stored(contained(docs, items, threshold).select("doc_key").distinct(), "contaminated")
    return docs.join(bad, F.unhex(F.md5(whole_text(docs["text"]))) == bad["doc_key"], "left_anti")
