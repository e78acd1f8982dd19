"""One-permutation MinHash fingerprints of documents, and how alike neighbouring and edited texts are by them.

Each shingle of five words is hashed once. The upper bits of the hash name one of 256 bins and a bin keeps
its least hash. A bin that got none takes the value of another: it asks bins in an order of its own, fixed by
a hash of bin and attempt, until one that got a shingle answers (optimal densification), so equal bins of two
texts still agree with the probability of their Jaccard similarity. Of each bin the four low-order bits are
stored, two bins a byte. Bits of different shingles agree by chance once in 16, which the likeness corrects:
(share of equal bins - 1/16) / (1 - 1/16), and 0 where that is negative.

The edited text of a document needs the next document by id. Texts are dealt to tasks by ranges of ids and
walked in order, one task a range; the last text of a range meets the first one of the next range afterwards,
in a join of one row for each range. Copies of one id are dealt by a hash of the text and a row number, so no
id is too common.

Defined cases: a NULL text is empty. A text without words has an empty fingerprint, is quite like another
such text (1.0) and not like any other (0.0). A NULL doc_id comes before all others. Rows of one doc_id
follow each other by the hash of their texts. A single document is its own next one. An empty table gives no
rows. Other columns of the input are not read.
"""

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from divtide.llm.common import stored, whole_text
from divtide.llm.shingles import mix, shingle_runs

BINS = 256
BITS = 4
CHANCE = 1 / (1 << BITS)
ATTEMPTS = 16  # donors that are asked at once
TOGETHER = 512  # texts that are edited and fingerprinted together
RESULT = {
    "doc_id": pa.int64(),
    "n_chars": pa.int64(),
    "edited_sha256": pa.binary(),
    "fingerprint": pa.binary(),
    "edited_fingerprint": pa.binary(),
    "near_edited": pa.float64(),
    "near_next": pa.float64(),
}
# Besides results: the first and the last text of each range.
WALKED = {"kind": pa.int32(), **RESULT, "part": pa.int64(), "text": pa.string()}
TYPES = {pa.int64(): "long", pa.int32(): "int", pa.binary(): "binary", pa.float64(): "double", pa.string(): "string"}
DONE, FIRST, LAST = 0, 1, 2


def spark_schema(columns: dict[str, pa.DataType]) -> str:
    return ", ".join(f"{name} {TYPES[kind]}" for name, kind in columns.items())


@lru_cache(maxsize=1024)
def donors(block: int) -> np.ndarray:
    """Which bin each bin asks in ATTEMPTS attempts in a row."""
    attempt = np.arange(block * ATTEMPTS, (block + 1) * ATTEMPTS, dtype=np.uint64)[:, None]
    asked = mix(mix(np.arange(1, BINS + 1, dtype=np.uint64)[None, :]) + attempt)
    return (asked >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)


def bins_of(shingles: np.ndarray) -> np.ndarray:
    """The low-order bits of each bin; there is at least one shingle."""
    # The upper bits name the bin, so in ascending order the first of a bin is its least.
    ordered = np.sort(shingles)
    place = (ordered >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    first = np.ones(len(place), bool)
    np.not_equal(place[1:], place[:-1], out=first[1:])
    filled = np.zeros(BINS, bool)
    filled[place[first]] = True
    bins = np.zeros(BINS, np.uint8)
    bins[place[first]] = (ordered[first] & np.uint64((1 << BITS) - 1)).astype(np.uint8)
    empty, block = np.flatnonzero(~filled), 0
    while len(empty):
        asked = donors(block)[:, empty]
        answers = filled[asked]
        found = answers.any(axis=0)
        donor = asked[answers.argmax(axis=0), np.arange(len(empty))]
        bins[empty[found]] = bins[donor[found]]
        empty, block = empty[~found], block + 1
    return bins


def fingerprints(texts: list[str]) -> list[np.ndarray | None]:
    """The bins of each text, None for one without words."""
    out: list[np.ndarray | None] = []
    for _, shingles, starts in shingle_runs(texts):
        for begin, end in zip(starts[:-1].tolist(), starts[1:].tolist()):
            out.append(bins_of(shingles[begin:end]) if end > begin else None)
    return out


def packed(bins: np.ndarray | None) -> bytes:
    return b"" if bins is None else (bins[::2] << BITS | bins[1::2]).tobytes()


def likeness(one: np.ndarray | None, other: np.ndarray | None) -> float:
    """Estimated Jaccard similarity of the shingles behind two fingerprints."""
    if one is None or other is None:
        return float(one is other)
    equal = int(np.count_nonzero(one == other)) / BINS
    return max(0.0, (equal - CHANCE) / (1 - CHANCE))


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by the beginning of the one that follows."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def compared(ids: list, texts: list[str], prints: list) -> dict[str, list]:
    """Results of all texts but the last, each with the one behind it as its next."""
    columns: dict[str, list] = {name: [] for name in RESULT}
    for at in range(0, len(texts) - 1, TOGETHER):
        rows = range(at, min(at + TOGETHER, len(texts) - 1))
        changed = [edited(texts[i], texts[i + 1]) for i in rows]
        for i, text, own in zip(rows, changed, fingerprints(changed)):
            columns["doc_id"].append(ids[i])
            columns["n_chars"].append(len(texts[i]))
            columns["edited_sha256"].append(hashlib.sha256(text.encode()).digest())
            columns["fingerprint"].append(packed(prints[i]))
            columns["edited_fingerprint"].append(packed(own))
            columns["near_edited"].append(likeness(prints[i], own))
            columns["near_next"].append(likeness(prints[i], prints[i + 1]))
    return columns


def batch_of(schema: dict[str, pa.DataType], columns: dict[str, list]) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    arrays = [pa.array(columns[name], kind) if name in columns else pa.nulls(n, kind) for name, kind in schema.items()]
    return pa.RecordBatch.from_arrays(arrays, names=list(schema))


def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results within a range of documents in order, and its first and last text."""
    part, held = TaskContext.get().partitionId(), ([], [], [])

    def end(kind: int, doc_id, text: str) -> pa.RecordBatch:
        return batch_of(WALKED, {"kind": [kind], "doc_id": [doc_id], "part": [part], "text": [text]})

    for batch in batches:
        if not batch.num_rows:
            continue
        ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        if not held[0]:
            yield end(FIRST, ids[0], texts[0])
        rows = [old + new for old, new in zip(held, (ids, texts, fingerprints(texts)))]
        columns = compared(*rows)
        yield batch_of(WALKED, {"kind": [DONE] * len(columns["doc_id"]), **columns})
        held = tuple(x[-1:] for x in rows)
    if held[0]:
        yield end(LAST, held[0][0], held[1][0])


def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of single texts whose next one stands beside them."""
    for batch in batches:
        for doc_id, text, following in zip(*(c.to_pylist() for c in batch.columns)):
            texts = [text, following]
            yield batch_of(RESULT, compared([doc_id, None], texts, fingerprints(texts)))


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """The digest columns of each document, its fingerprints and checksum as binary."""
    spark = docs.sparkSession
    text = whole_text("text")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text.alias("text"),
        F.xxhash64(text).alias("hash"),
        F.monotonically_increasing_id().alias("number"),
    )
    order = ["doc_id", "hash", "number"]
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    steps = stored(ranges.mapInArrow(walked, spark_schema(WALKED)), "fingerprints", compression="zstd")

    # One number for each task that had rows; after the last range comes the first.
    parts = sorted(r["part"] for r in steps.where(F.col("kind") == FIRST).select("part").collect())
    following = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part long, next long")
    first = steps.where(F.col("kind") == FIRST).select(F.col("part").alias("next"), F.col("text").alias("following"))
    last = steps.where(F.col("kind") == LAST).select("part", "doc_id", "text")
    ends = last.join(following, "part").join(first, "next").select("doc_id", "text", "following")
    return steps.where(F.col("kind") == DONE).select(*RESULT).unionByName(ends.mapInArrow(paired, spark_schema(RESULT)))
