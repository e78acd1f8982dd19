"""What the text operators share: reading, scratch tables, the definition of a word."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from divtide.session import scratch_dir

# Words are runs of characters other than these six.
SPACE = r"[ \t-\r]"
NOT_SPACE = r"[^ \t-\r]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def whole_text(text: Column | str) -> Column:
    """The text, empty where there is none."""
    return F.coalesce(text if isinstance(text, Column) else F.col(text), F.lit(""))


def words(text: Column) -> Column:
    """The words of a text in order."""
    return F.array_remove(F.split(text, f"{SPACE}+"), "")


def held_out(doc_id: Column, divisor: int, remainder: int = 2) -> Column:
    """True for the rows that a model must not learn from; a row without id is held out too."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % divisor == remainder, F.lit(True))


def stored(df: DataFrame, purpose: str, **options: str) -> DataFrame:
    """`df` written once to a new folder below `spark.checkpoint.dir` and read back.

    Cuts the lineage without depending on any executor: a lost one costs a reread, no recomputation.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
