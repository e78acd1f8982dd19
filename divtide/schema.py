"""Schemas of the raw, staged and modelled relations."""

from pyspark.sql import types as T

# The ten raw columns, all text, in load order.
RAW_COLUMNS = [
    "cash_amount",
    "currency",
    "declaration_date",
    "dividend_type",
    "ex_dividend_date",
    "frequency",
    "id",
    "pay_date",
    "record_date",
    "ticker",
]

# The same columns in the order of the warehouse table.
TABLE_COLUMNS = [
    "cash_amount",
    "currency",
    "dividend_type",
    "ex_dividend_date",
    "frequency",
    "id",
    "pay_date",
    "record_date",
    "ticker",
    "declaration_date",
]

# Columns that the staged relation must have filled.
NOT_NULL_COLUMNS = ["ticker", "ex_dividend_date", "cash_amount", "pay_date"]

CORRUPT_COLUMN = "_corrupt_record"
BATCH_COLUMN = "ingest_batch"


def all_text(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


RAW_SCHEMA = all_text(RAW_COLUMNS)

PAGE_SCHEMA = T.StructType(
    [
        T.StructField("status", T.StringType()),
        T.StructField("next_url", T.StringType()),
        # Where landed pages say so: the walk they belong to, their place in it, and how the request ended.
        T.StructField("run", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("http_status", T.IntegerType()),
        T.StructField("results", T.ArrayType(RAW_SCHEMA)),
        T.StructField(CORRUPT_COLUMN, T.StringType()),
    ]
)

PERSON_SCHEMA = all_text(["craft", "name"])

PEOPLE_SCHEMA = T.StructType(
    [
        T.StructField("number", T.IntegerType()),
        T.StructField("people", T.ArrayType(PERSON_SCHEMA)),
    ]
)
