import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use themselves.
        T.StructField("row", T.StringType()),
        T.StructField("line", T.StringType()),
        T.StructField("size", T.IntegerType()),
    ]
)


@pytest.fixture
def frame(spark):
    """Documents from (doc_id, text) pairs, with columns that clash."""

    def make(pairs, partitions=2):
        rows = [(i, t, None, "src", None if t is None else len(t), "r", None, 1) for i, t in pairs]
        return spark.createDataFrame(rows, DOCS).repartition(partitions)

    return make


def prose(seed: int, n: int) -> str:
    """`n` words that are hardly in another text."""
    words = [f"w{(seed * 7919 + i * 104729) % 99991:x}q" for i in range(n)]
    return " ".join("".join(c if c.isalpha() else "ghijklmnop"[int(c)] for c in w) for w in words)


EDGES = [
    (1, None),
    (None, "one two three"),
    (2, ""),
    (3, " \n\t \r\n"),
    (4, "a"),
    (5, prose(1, 60)),
    (5, prose(1, 60)),
    (6, prose(2, 30_000)),
    (7, "naïve  spaces   here \x0b and\x0cthere\n\n" + prose(3, 8)),
]
