"""Bringing frames to the raw schema, flattening, and unions."""

from collections.abc import Iterator
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from divtide.schema import RAW_COLUMNS


def conform(df: DataFrame, columns: list[str] = RAW_COLUMNS) -> DataFrame:
    """Exactly `columns`, in that order, as text: cast what is there, NULL for what is not.

    One projection, so the scan below reads only the wanted columns.
    """
    present = set(df.columns)
    return df.select(
        [(F.col(f"`{c}`") if c in present else F.lit(None)).cast("string").alias(c) for c in columns]
    )


def flatten(df: DataFrame) -> DataFrame:
    """Nested objects as dotted columns; arrays stay as they are. Fails if two columns would share a name."""

    def leaves(schema: T.StructType, path: tuple[str, ...] = ()) -> Iterator[Column]:
        for field in schema:
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                yield from leaves(field.dataType, here)
            else:
                yield F.col(".".join(f"`{part}`" for part in here)).alias(".".join(here))

    flat = df.select(list(leaves(df.schema)))
    twice = {c for c in flat.columns if flat.columns.count(c) > 1}
    if twice:
        raise ValueError(f"dotted and nested columns give the same name: {sorted(twice)}")
    return flat


def union_rows(history: DataFrame, batch: DataFrame) -> DataFrame:
    """All rows of both after bringing both to the raw schema; repeats are kept."""
    return conform(history).unionByName(conform(batch))


def strict_union(history: DataFrame, batch: DataFrame) -> DataFrame:
    """All rows of both, without casts: columns, order and types must already agree."""
    left = [(f.name, f.dataType) for f in history.schema]
    right = [(f.name, f.dataType) for f in batch.schema]
    if left != right:
        raise ValueError(f"schemas differ: {left} and {right}")
    return history.union(batch)


def null_safe_semi(rows: DataFrame, keys: DataFrame, columns: list[str], anti: bool = False) -> DataFrame:
    """Rows whose `columns` are among `keys`, or are not with `anti`; NULLs compare as equal."""
    same = reduce(and_, [F.col(f"rows.{c}").eqNullSafe(F.col(f"keys.{c}")) for c in columns])
    return rows.alias("rows").join(keys.alias("keys"), same, "left_anti" if anti else "left_semi")
