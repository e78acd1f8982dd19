"""The staging area: CSV with a header that holds the latest batch only.

A line of a file is a row, whatever the texts hold, so Spark reads a large file in as many tasks as it needs:
line breaks are written as `\\n` and `\\r`, and the backslash that marks them as `\\b`. Every backslash in a file
thus begins one of the three, and reading turns each back into what it stands for.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from divtide.operators.normalize import conform
from divtide.schema import RAW_COLUMNS, all_text

# Quotes are doubled, spaces kept, NULL and empty text both written as nothing.
CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "emptyValue": "",
}

# In the order of writing; reading takes the marks back from the last to the first.
MARKS = [("\\", "\\b"), ("\n", "\\n"), ("\r", "\\r")]


def on_one_line(text: Column) -> Column:
    for plain, mark in MARKS:
        text = F.replace(text, F.lit(plain), F.lit(mark))
    return text


def as_written(line: Column) -> Column:
    for plain, mark in reversed(MARKS):
        line = F.replace(line, F.lit(mark), F.lit(plain))
    return line


def write_staging(batch: DataFrame, path: str) -> None:
    """Replaces the staging area by `batch`."""
    rows = conform(batch)
    rows.select([on_one_line(F.col(c)).alias(c) for c in rows.columns]).write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def read_staging(spark: SparkSession, path: str, columns: list[str] = RAW_COLUMNS) -> DataFrame:
    """The staged rows as text, brought to the raw schema. `columns` are those the files hold."""
    rows = conform(spark.read.schema(all_text(columns)).options(**CSV_OPTIONS).csv(path))
    return rows.select([as_written(F.col(c)).alias(c) for c in rows.columns])


def clear_staging(spark: SparkSession, path: str) -> None:
    """Leaves one file with the header only."""
    spark.createDataFrame([], all_text(RAW_COLUMNS)).coalesce(1).write.mode("overwrite").options(
        **CSV_OPTIONS
    ).csv(path)
