"""The raw table and the model tables in the Spark catalog."""

import time
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from divtide.operators.normalize import conform
from divtide.schema import BATCH_COLUMN, RAW_COLUMNS, TABLE_COLUMNS


# How long a replaced build of a model table stays readable.
BUILD_SECONDS = 24 * 3600


def create_database(spark: SparkSession, name: str, location: str) -> None:
    """A database whose tables lie below `location`, a folder that every executor can reach."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{location}'")


def create_raw_table(spark: SparkSession, table: str, by_batch: bool = False) -> None:
    """The raw table of ten text columns, unless it is there.

    With `by_batch` it is partitioned by the batch that brought the rows.
    """
    columns = ", ".join(f"{c} STRING" for c in TABLE_COLUMNS)
    partitions = f"PARTITIONED BY ({BATCH_COLUMN} STRING)" if by_batch else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet {partitions}")


def append_raw(batch: DataFrame, table: str) -> None:
    """Adds rows to the raw table, matching columns by name."""
    conform(batch).write.format("parquet").mode("append").saveAsTable(table)


def replace_batch(batch: DataFrame, table: str, batch_id: str) -> None:
    """Adds rows as the partition of a batch; the same batch again replaces that partition only."""
    spark = batch.sparkSession
    columns = ", ".join(TABLE_COLUMNS)
    spark.sql(
        f"INSERT OVERWRITE {table} PARTITION ({BATCH_COLUMN} = '{batch_id}') SELECT {columns} FROM {{rows}}",
        rows=conform(batch),
    )


def read_raw(spark: SparkSession, table: str, batch_id: str | None = None) -> DataFrame:
    """The rows of the raw table, or those of one batch read from its partition only."""
    rows = spark.table(table)
    if batch_id is not None:
        rows = rows.where(F.col(BATCH_COLUMN) == batch_id)
    return rows.select(RAW_COLUMNS)


def table_location(spark: SparkSession, table: str) -> str:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()["data_type"]


def replace_table(df: DataFrame, table: str) -> DataFrame:
    """Rebuilds a model table and returns it as stored.

    The rows are written to a folder of their own; then the table is pointed there. Readers find the
    old or the new rows, whole, and a failed rebuild changes nothing. Builds stay for a while after
    they were replaced, so whoever has begun to read one can end. A session that has read the table
    before sees the new rows after `REFRESH TABLE`.
    """
    spark = df.sparkSession
    database, name = table.split(".")
    exists = spark.catalog.tableExists(table)
    builds = f"{spark.catalog.getDatabase(database).locationUri}/{name}"
    location = f"{builds}/build-{uuid4().hex}"
    df.write.parquet(location)
    if exists and spark.table(table).dtypes != df.dtypes:
        spark.sql(f"DROP TABLE {table}")
        exists = False
    if exists:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
    else:
        spark.catalog.createTable(table, location, "parquet")
    spark.catalog.refreshTable(table)
    drop_old_builds(spark, builds, location)
    return spark.table(table)


def drop_old_builds(spark: SparkSession, builds: str, current: str, seconds: float = BUILD_SECONDS) -> None:
    """Removes builds other than the current one that were written longer ago than `seconds`."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(builds)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(folder):
        path, age = status.getPath(), time.time() - status.getModificationTime() / 1000
        if path.getName().startswith("build-") and path.getName() != current.rsplit("/", 1)[1] and age > seconds:
            files.delete(path, True)
