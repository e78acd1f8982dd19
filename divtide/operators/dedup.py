"""Latest version per event."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def drop_null_keys(df: DataFrame, key: str = "id") -> DataFrame:
    return df.where(F.col(key).isNotNull())


def keep_latest(df: DataFrame, key: str = "id", order: str = "record_date") -> DataFrame:
    """One row per `key`: the highest `order` as text, a NULL counting as highest.

    Ties go on to the other columns by name, so the result does not depend on the row order.
    Spark cuts each map task to one row per key before the shuffle (WindowGroupLimit), so a key
    that holds a third of the input still sends only one row per task.
    """
    ties = sorted(c for c in df.columns if c not in (key, order))
    latest_first = Window.partitionBy(key).orderBy([F.col(c).desc_nulls_first() for c in (order, *ties)])
    return df.withColumn("rn", F.row_number().over(latest_first)).where("rn = 1").drop("rn")
