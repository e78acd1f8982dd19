"""Raw documents to packed training sequences, in five stages.

Each stage works on all that the one before it kept. Stages return the columns of documents; the last returns
the pieces of the packed sequences.

Line dedup stands before the search for near copies. It leaves copies whole, since stripped of the lines they
share with their original they would pass that search as fragments; the search then decides on them.

Defined cases, from the operators: a NULL text is empty. Documents without words fail the quality rules, and
those that line dedup leaves without a word go with it. Very long texts are read whole and packed in pieces.
Of equal texts, and of rows that are repeated whole, one stays. NULL ids come after all others. Empty tables
give no rows. Extra columns, whatever their names, are carried until packing.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from divtide.llm import decontaminate, jaccard_join, line_templates, packing, quality_rules
from divtide.llm.common import NOT_SPACE, documents, stored, table
from divtide.llm.registry import tokenizer


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy of the quality rules rejects go."""
    return quality_rules.keep_good(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines whose template recurs across documents go, but for the first document that has them and for copies.

    A document of which no word is left goes too: other documents hold all its lines.
    """
    return line_templates.without_recurring_lines(docs, spare_copies=True).where(F.col("text").rlike(NOT_SPACE))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return jaccard_join.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenised pieces, with their ids, in their sequences."""
    return packing.pack(packing.pieces(docs, tokenizer("byte_bpe_50k.json")))


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("n-gram jaccard join", near_stage),
    ("benchmark decontamination", decontamination_stage),
    ("packing", packing_stage),
]
# Byte-pair tokens and best-fit packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`, each written and reread by the next."""
    docs = documents(spark, sf_dir)
    for place, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place + 1 < len(STAGES):
            docs = stored(docs, name.replace(" ", "-"))
    return docs
