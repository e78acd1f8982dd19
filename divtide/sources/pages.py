"""Landed JSON pages: an object with `results` (an array of objects) and perhaps `next_url`."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from divtide.operators.normalize import flatten
from divtide.schema import CORRUPT_COLUMN, PAGE_SCHEMA, PEOPLE_SCHEMA, PERSON_SCHEMA, RAW_COLUMNS, RAW_SCHEMA

# The people shown when the people source cannot be read.
FALLBACK_PEOPLE = [
    ("ISS", "Oleg Kononenko"),
    ("ISS", "Nikolai Chub"),
    ("ISS", "Tracy Caldwell Dyson"),
    ("ISS", "Matthew Dominick"),
    ("ISS", "Michael Barratt"),
    ("ISS", "Jeanette Epps"),
    ("ISS", "Alexander Grebenkin"),
    ("ISS", "Butch Wilmore"),
    ("ISS", "Sunita Williams"),
    ("Tiangong", "Li Guangsu"),
    ("Tiangong", "Li Cong"),
    ("Tiangong", "Ye Guangfu"),
]
FALLBACK_NUMBER = 12


def read_pages(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """One row per page. Every field is read as text, so no pass over the data infers types.

    By default each line is a page and Spark splits large files. With `multi_line` each file is a
    page. A page that is no JSON keeps its text in the corrupt column.
    """
    return spark.read.schema(PAGE_SCHEMA).option("multiLine", multi_line).json(path)


def page_rows(pages: DataFrame) -> DataFrame:
    """The raw rows in `results`; a page whose `results` is missing or empty adds none, nor does a null in it."""
    rows = F.filter("results", lambda row: row.isNotNull())
    return pages.where(F.col(CORRUPT_COLUMN).isNull()).select(F.inline(rows)).select(RAW_COLUMNS)


def rejected_pages(pages: DataFrame) -> DataFrame:
    """Pages that are no JSON or not of the page's form: their text, and what could be read of them.

    `readable_rows` is NULL where `results` was not readable. It is selected for a reason: Spark looks at the
    form of `results` only if a query needs it, and else takes a page with wrong ones for a good one.
    """
    readable = F.when(F.col("results").isNotNull(), F.size("results"))
    return pages.where(F.col(CORRUPT_COLUMN).isNotNull()).select(
        F.col(CORRUPT_COLUMN).alias("page"), "status", readable.alias("readable_rows")
    )


def no_rows(spark: SparkSession) -> DataFrame:
    """The raw relation without rows."""
    return spark.createDataFrame([], RAW_SCHEMA)


def nested_pages(spark: SparkSession, path: str, row: T.StructType) -> DataFrame:
    """Pages whose `results` hold nested objects of the form `row`; read once, no types inferred."""
    fields = [T.StructField("status", T.StringType()), T.StructField("results", T.ArrayType(row))]
    return spark.read.schema(T.StructType([*fields, T.StructField(CORRUPT_COLUMN, T.StringType())])).json(path)


def read_nested(spark: SparkSession, path: str, row: T.StructType) -> DataFrame:
    """`results` with nested objects as dotted columns; pages of another form are in `rejected_pages`."""
    pages = nested_pages(spark, path, row).where(F.col(CORRUPT_COLUMN).isNull())
    return flatten(pages.select(F.inline(F.filter("results", lambda x: x.isNotNull()))))


def fallback_people(spark: SparkSession) -> DataFrame:
    people = spark.createDataFrame(FALLBACK_PEOPLE, PERSON_SCHEMA)
    return people.select(F.lit(FALLBACK_NUMBER).alias("number"), "craft", "name")


def people(spark: SparkSession, path: str) -> DataFrame:
    """`(number, craft, name)`, one row per listed person; the fallback if no list has landed.

    A list without `number` keeps its people, with NULL there.
    """
    try:
        lists = spark.read.schema(PEOPLE_SCHEMA).json(path).where("people IS NOT NULL")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return fallback_people(spark)
    if lists.isEmpty():
        return fallback_people(spark)
    return lists.select("number", F.inline(F.filter("people", lambda person: person.isNotNull())))
