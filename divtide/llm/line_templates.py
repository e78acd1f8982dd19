"""Drops lines whose template recurs across documents, by a log-template tree of fixed depth.

A line's fields that are surely variable (words with a digit or an @) are masked. The tree's first level is the
number of words, the next are the four leading words; a leaf holds all lines that agree in those. A leaf's
template has at each position the word that more than half of its lines have there (each distinct line weighted
by its documents), and a variable elsewhere. A line belongs to it if 60 % of its words behind the leading ones,
and one at least, are the template's; other lines are their own template. A template recurs if enough documents have it; the document with the
least doc_id (then the least checksum) keeps its lines, all others lose theirs, so nothing vanishes wholly.

The texts are read three times: to number lines, to fetch the words of lines in leaves that hold several
different lines, and to drop. In between only fingerprints move.

Defined cases: NULL and empty texts have no lines and come out empty. Lines without words stay. Rows with the
same id and text are one document. NULL ids come after all others. Recurrence within one document does not
count. Other columns are carried unchanged, whatever their names.
"""

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from divtide.llm.bitmap import bitmap, is_marked, opened_bytes
from divtide.llm.common import stored, whole_text

LEADING = 4
SHARE = 0.6
# Lines of LONG words or more recur in two documents already, shorter ones in SHORT_DOCS.
LONG, LONG_DOCS, SHORT_DOCS = 16, 2, 8
COPY = 0.5  # share of the words of both documents that makes one a copy of the other
VARIABLE = re.compile(rb"[0-9@]")
FIELD = b"<*>"


def parsed(text: str) -> Iterator[list[bytes]]:
    """The masked words of each line; UTF-8, whose `split` knows just the six white-space codes."""
    for line in text.encode("utf-8", "surrogatepass").split(b"\n"):
        words = line.split()
        if VARIABLE.search(line):
            words = [FIELD if VARIABLE.search(w) else w for w in words]
        yield words


def leaf_of(words: list[bytes]) -> int:
    return xxhash.xxh3_64_intdigest(b"%d %b" % (len(words), b" ".join(words[:LEADING]))) - (1 << 63)


def line_of(words: list[bytes]) -> bytes:
    return hashlib.md5(b" ".join(words), usedforsecurity=False).digest()


def needed(n_words: Column) -> Column:
    """In how many documents a line of so many words must stand to be dropped."""
    return F.when(n_words >= LONG, LONG_DOCS).otherwise(SHORT_DOCS)


def identified(docs: DataFrame, *carried: Column) -> DataFrame:
    """doc_id, a checksum of id and text as `ident`, text, and what is carried along."""
    text, doc_id = whole_text("text"), F.col("doc_id").cast("long")
    ident = F.unhex(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("\n"), text)))
    return docs.select(doc_id.alias("doc_id"), ident.alias("ident"), text.alias("text"), *carried)


LINE_SCHEMA = "doc_id long, ident binary, leaf long, line binary, n_words int"


def lines_of(docs: DataFrame) -> DataFrame:
    """One row for each document and distinct line."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, leaves, lines, n_words = [], [], [], []
            for row, text in enumerate(batch.column(2).to_pylist()):
                seen = {line_of(words): (leaf_of(words), len(words)) for words in parsed(text) if words}
                rows.extend([row] * len(seen))
                lines.extend(seen)
                leaves.extend(leaf for leaf, _ in seen.values())
                n_words.extend(n for _, n in seen.values())
            taken = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(taken),
                    batch.column(1).take(taken),
                    pa.array(leaves, pa.int64()),
                    pa.array(lines, pa.binary()),
                    pa.array(n_words, pa.int32()),
                ],
                names=["doc_id", "ident", "leaf", "line", "n_words"],
            )

    return identified(docs).mapInArrow(read, LINE_SCHEMA).dropDuplicates(["ident", "line"])


WORDS_SCHEMA = "line binary, words array<string>"


def words_in(docs: DataFrame, leaves: DataFrame) -> DataFrame:
    """The words of lines in these leaves (and of a few others), each line once in a task."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(leaves.select(F.col("leaf").alias("print"))))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = opened_bytes(shared.value)
        for batch in batches:
            found: dict[bytes, list[bytes]] = {}
            for text in batch.column(0).to_pylist():
                for words in parsed(text):
                    if words and is_marked(wanted, leaf_of(words)):
                        found.setdefault(line_of(words), words)
            texts = [[w.decode("utf-8", "surrogatepass") for w in words] for words in found.values()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.binary()), pa.array(texts, pa.list_(pa.string()))], names=["line", "words"]
            )

    return docs.select(whole_text("text").alias("text")).mapInArrow(fetch, WORDS_SCHEMA)


def template_lines(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """The lines (column `line`) that belong to the template of their leaf."""
    counted = stored(lines.groupBy("leaf", "line").agg(F.count("*").alias("docs"), F.first("n_words").alias("n_words")), "line-counts")
    # More than one line, or there is nothing to generalise.
    leaves = counted.groupBy("leaf").agg(F.count("*").alias("n"), F.sum("docs").alias("leaf_docs"), F.max("n_words").alias("n_words"))
    leaves = stored(leaves.where((F.col("n") > 1) & (F.col("leaf_docs") >= needed(F.col("n_words")))), "leaves")
    words = words_in(docs, leaves).groupBy("line").agg(F.first("words").alias("words"))
    places = F.transform("words", lambda w, i: F.concat(i.cast("string"), F.lit(" "), w))
    open_lines = counted.join(leaves.select("leaf", "leaf_docs"), "leaf").join(words, "line")
    open_lines = stored(open_lines.select("leaf", "line", "docs", "leaf_docs", "n_words", places.alias("places")), "open-lines")
    common = (
        open_lines.select("leaf", "docs", "leaf_docs", F.explode("places").alias("place"))
        .groupBy("leaf", "place")
        .agg(F.sum("docs").alias("docs"), F.first("leaf_docs").alias("leaf_docs"))
        .where("2 * docs > leaf_docs")
    )
    templates = stored(common.groupBy("leaf").agg(F.collect_list("place").alias("constants")), "templates")
    alike = F.size(F.array_intersect("places", "constants"))
    # All lines of a leaf agree in the leading words, so these tell nothing; shorter lines are alone in theirs.
    enough = F.greatest(F.lit(1.0), (F.col("n_words") - LEADING) * SHARE)
    return open_lines.join(templates, "leaf").where(alike - LEADING >= enough - 1e-9).select("line")


def copies(lines: DataFrame, lost: DataFrame) -> DataFrame:
    """ident of documents that share COPY of their words or more with the one document that keeps these, and that
    make up as much of it: copies, rather than documents with lines from elsewhere."""
    words = stored(lines.groupBy("ident").agg(F.sum("n_words").alias("words")), "line-words")
    shared = lost.groupBy("ident", "keeper").agg(F.sum("n_words").alias("shared"))
    kept = words.select(F.col("ident").alias("keeper"), F.col("words").alias("keeper_words"))
    alike = shared.join(words, "ident").join(kept, "keeper")
    return alike.where(F.col("shared") >= COPY * F.greatest("words", "keeper_words") - 1e-9).select("ident")


def recurring(docs: DataFrame, spare_copies: bool = False) -> DataFrame:
    """ident and `drop`, the fingerprints of lines that this document loses; with `spare_copies`, none of a copy's."""
    lines = stored(lines_of(docs), "lines")
    alike = stored(template_lines(docs, lines).withColumn("templated", F.lit(True)), "template-lines")
    own = F.when(F.col("templated"), F.lit(b"")).otherwise(F.col("line"))
    lines = stored(lines.join(alike, "line", "left").select("doc_id", "ident", "leaf", "line", "n_words", own.alias("own")), "grouped")
    key = ["leaf", "own"]
    held = lines.groupBy(*key, "ident").agg(F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "ident")
    groups = held.groupBy(*key).agg(F.count("*").alias("docs"), F.max("n_words").alias("n_words"), F.min(order).alias("first"))
    groups = groups.where(F.col("docs") >= needed(F.col("n_words"))).select(*key, F.col("first.ident").alias("keeper"))
    lost = lines.join(stored(groups, "recurring"), key).where("ident != keeper")
    if spare_copies:
        lost = stored(lost.select("ident", "keeper", "line", "n_words"), "lost")
        lost = lost.join(copies(lines, lost), "ident", "left_anti")
    return lost.groupBy("ident").agg(F.collect_list("line").alias("drop"))


def dedup_lines(docs: DataFrame, spare_copies: bool = False) -> DataFrame:
    """`row` (the other columns), `text` without the dropped lines, n_lines, n_dropped (long)."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    lost = stored(recurring(docs, spare_copies), "dropped")
    joined = identified(docs, row.alias("row")).join(lost, "ident", "left")
    shape = T.StructType(
        [joined.schema["row"], T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]
    )

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_lines, n_dropped = [], [], []
            for text, drop in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                lines = text.split("\n")
                gone = set(drop or ())
                kept = [x for x, words in zip(lines, parsed(text)) if line_of(words) not in gone] if gone else lines
                texts.append("\n".join(kept))
                n_lines.append(len(lines) if text else 0)
                n_dropped.append(len(lines) - len(kept))
            columns = [pa.array(texts, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["row", "text", "n_lines", "n_dropped"])

    return joined.select("row", "text", "drop").mapInArrow(rewrite, shape)


def without_recurring_lines(docs: DataFrame, spare_copies: bool = False) -> DataFrame:
    """The documents with their new texts, all columns; `n_chars`, if there is one, follows the text.

    With `spare_copies`, a document that is a copy of another stays whole, for a later search for near copies:
    stripped of what both share, its rest would no longer be known as one.
    """
    new = {"text": F.col("text"), "n_chars": F.char_length("text").cast("long")}
    return dedup_lines(docs, spare_copies).select(*[(new[c] if c in new else F.col("row").getField(c)).alias(c) for c in docs.columns])
