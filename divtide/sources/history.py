"""The raw history: a Parquet folder that only grows."""

import json
import re
from functools import reduce
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from divtide.operators.normalize import conform
from divtide.schema import BATCH_COLUMN, RAW_COLUMNS, RAW_SCHEMA, all_text
from divtide.sources.parts import BUILD_SECONDS, TIER, Files, PartTable

# Spark names the files of one write alike: a part number, the write, a counter.
WRITE_OF_FILE = re.compile(r"part-\d+-(.+?)(?:[-_.]c\d+)?(?:\.[a-z0-9]+)*\.parquet$")


FORMS = all_text(["folder", "form"])


def forms(spark: SparkSession, path: str) -> PartTable:
    """A record for each write of a form of its own: its folder and its schema."""
    return PartTable(spark, f"{path}/_forms", FORMS, ["folder"], parts=1)


def append_form(batch: DataFrame, path: str) -> None:
    """Adds rows to the history in the columns and types they have, and records these.

    The history is then read by one scan for each form, planned from the records: no file is opened to see what
    it holds, however many writes there were.
    """
    spark = batch.sparkSession
    folder = f"_forms/rows/{uuid4().hex}"
    batch.write.parquet(f"{path}/{folder}")
    forms(spark, path).append(spark.createDataFrame([(folder, batch.schema.json())], FORMS))


def recorded(spark: SparkSession, path: str) -> list[DataFrame]:
    """The rows of recorded writes as text, one frame for each form."""
    by_form = forms(spark, path).read().groupBy("form").agg(F.collect_list("folder").alias("folders")).collect()
    return [
        conform(spark.read.schema(T.StructType.fromJson(json.loads(r["form"]))).parquet(*[f"{path}/{f}" for f in r["folders"]]))
        for r in by_form
    ]


def read_path(spark: SparkSession, path: str) -> DataFrame:
    """The raw rows below one path, whose writes may differ in columns and types."""
    own = Files(spark).names(path)
    known = recorded(spark, path) if "_forms" in own else []
    if known and all(name.startswith(("_", ".")) for name in own):
        return reduce(DataFrame.unionByName, known)
    return reduce(DataFrame.unionByName, [unrecorded(spark, path), *known])


def unrecorded(spark: SparkSession, path: str) -> DataFrame:
    """The rows of files of which nothing is recorded.

    Columns are merged over all files. Where types differ and cannot be merged, files are grouped by the write
    they come from, which gave all its files one schema; each schema is read and brought to text by itself.
    """
    try:
        return conform(spark.read.option("mergeSchema", True).parquet(path))
    except Py4JJavaError as error:
        if "CANNOT_MERGE_SCHEMAS" not in str(error.java_exception):
            raise
    writes: dict[str, list[str]] = {}
    for file in spark.read.schema(RAW_SCHEMA).parquet(path).inputFiles():
        found = WRITE_OF_FILE.search(file)
        writes.setdefault(found[1] if found else file, []).append(file)
    by_schema: dict[str, list[str]] = {}
    for files in writes.values():
        by_schema.setdefault(spark.read.parquet(files[0]).schema.json(), []).extend(files)
    return reduce(DataFrame.unionByName, [conform(spark.read.parquet(*files)) for files in by_schema.values()])


def read_history(spark: SparkSession, *paths: str) -> DataFrame:
    """The raw rows below each path, which may differ in columns and types, also within a path."""
    return reduce(DataFrame.unionByName, [read_one(spark, p) for p in paths])


def read_one(spark: SparkSession, path: str) -> DataFrame:
    """A history that was compacted is read from its merged files, and the batches stored since."""
    if compacted(spark, path) is None:
        return read_path(spark, path)
    return batches(spark, path).select(RAW_COLUMNS)


def batch_folder(path: str, batch_id: str) -> str:
    return f"{path}/{BATCH_COLUMN}={batch_id}"


def append_history(batch: DataFrame, path: str, batch_id: str | None = None) -> None:
    """Adds `batch` to the history, creating it if needed, and rewrites nothing that is there.

    With `batch_id` the rows go to a partition of their own, so doing the same batch again replaces it and adds
    nothing twice, also if it has no rows any more. A history is kept either with ids or without.
    """
    rows = conform(batch)
    if batch_id is None:
        rows.write.mode("append").parquet(path)
        return
    rows.write.mode("overwrite").parquet(batch_folder(path, batch_id))
    state = compacted(batch.sparkSession, path)
    if state and is_compacted(batch.sparkSession, path, state, batch_id):
        # Its folder counts again, and its rows in the merged files no more.
        pending = [b for b in state["pending"] if b != batch_id]
        commit(batch.sparkSession, path, state, pending=pending, again=sorted({*state["again"], batch_id}))


# Compaction. Spark passes over names that begin with `_` when it lists a history.

COMPACTED_SCHEMA = all_text([*RAW_COLUMNS, BATCH_COLUMN])


def compacted(spark: SparkSession, path: str) -> dict | None:
    """What the newest manifest of a history says; None if it was never compacted.

    `folders` hold merged batches and their names, `pending` are merged batches whose own folders are still
    there, `again` are merged batches that were stored once more since, `retired` are folders no longer read.
    """
    files = Files(spark)
    numbers = sorted(int(n.removesuffix(".json")) for n in files.names(f"{path}/_builds") if n.endswith(".json"))
    return json.loads(files.read(f"{path}/_builds/{numbers[-1]:010d}.json")) if numbers else None


EMPTY = {"number": 0, "folders": [], "pending": [], "again": [], "retired": []}


def commit(spark: SparkSession, path: str, state: dict | None, **changes) -> None:
    before = state or EMPTY
    made = {**before, **changes, "number": before["number"] + 1}
    Files(spark).create(f"{path}/_builds/{made['number']:010d}.json", json.dumps(made))


def merged_names(spark: SparkSession, path: str, state: dict) -> DataFrame:
    return spark.read.schema(all_text([BATCH_COLUMN])).parquet(*[f"{path}/{f}/names" for f in state["folders"]])


def is_compacted(spark: SparkSession, path: str, state: dict, batch_id: str) -> bool:
    if not state["folders"]:
        return False
    return not merged_names(spark, path, state).where(F.col(BATCH_COLUMN) == batch_id).isEmpty()


def merged_rows(spark: SparkSession, path: str, state: dict) -> DataFrame:
    if not state["folders"]:
        return spark.createDataFrame([], COMPACTED_SCHEMA)
    rows = spark.read.schema(COMPACTED_SCHEMA).parquet(*[f"{path}/{f}/rows" for f in state["folders"]])
    return rows.where(~F.col(BATCH_COLUMN).isin(state["again"])) if state["again"] else rows


def single_batches(spark: SparkSession, path: str, state: dict | None) -> DataFrame:
    """Batches that lie in folders of their own."""
    try:
        rows = spark.read.schema(COMPACTED_SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COMPACTED_SCHEMA)
    return rows.where(~F.col(BATCH_COLUMN).isin(state["pending"])) if state and state["pending"] else rows


def sorted_by_batch(rows: DataFrame) -> DataFrame:
    """Rows in ranges of the batch and, within one, of the place where they were read, so that a batch of any
    size, or of copies of one row, is cut over as many tasks as there are."""
    placed = rows.withColumn("place", F.monotonically_increasing_id())
    return placed.repartitionByRange(BATCH_COLUMN, "place").sortWithinPartitions(BATCH_COLUMN).drop("place")


def compact_history(spark: SparkSession, path: str, seconds: float = BUILD_SECONDS) -> int:
    """Merges all batches that lie in folders of their own into few files; returns how many these were.

    Rows are sorted by batch, so that one batch can be read without the others. The merged files count from the
    moment that the manifest names them, whole. What they replace stays for `seconds`, for readers that have
    begun, and goes with a later compaction. A batch that is stored again still replaces itself: its merged rows
    are passed over, and left out when merged files are next written anew, as they are once there are many.
    """
    state, files = compacted(spark, path) or EMPTY, Files(spark)
    if files.names(f"{path}/_builds").get(f"{state['number']:010d}.json", 0) > seconds:
        for folder in [*(batch_folder(path, b) for b in state["pending"]), *(f"{path}/{f}" for f in state["retired"])]:
            files.delete(folder)
        state = {**state, "pending": [], "retired": []}
    held = single_batches(spark, path, state)
    names = sorted(r[0] for r in held.select(BATCH_COLUMN).distinct().collect())  # folders that are there now
    if not names:
        return 0
    listed = spark.createDataFrame([(n,) for n in names], all_text([BATCH_COLUMN]))
    folders = state["folders"]
    anew = bool(folders) and (bool(state["again"]) or len(folders) >= TIER)
    if anew:
        held = held.unionByName(merged_rows(spark, path, state))
        listed = listed.union(merged_names(spark, path, state)).distinct()
    merged = f"_compacted/{uuid4().hex}"
    sorted_by_batch(held).write.parquet(f"{path}/{merged}/rows")
    listed.coalesce(1).write.parquet(f"{path}/{merged}/names")
    changes = {"folders": [merged] if anew else [*folders, merged], "pending": sorted({*state["pending"], *names})}
    if anew:
        changes |= {"again": [], "retired": [*state["retired"], *folders]}
    commit(spark, path, state, **changes)
    return len(names)


def batches(spark: SparkSession, path: str) -> DataFrame:
    """The history with the batch of each row; no rows if there is none yet."""
    state = compacted(spark, path)
    rows = single_batches(spark, path, state)
    return rows.unionByName(merged_rows(spark, path, state)) if state else rows


def read_batches(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """The rows that some batches added, none if there are no such batches; only theirs are listed and read."""
    state, files = compacted(spark, path), Files(spark)
    merged = set(state["pending"]) if state else set()
    own = [n for n in names if n not in merged and files.exists(batch_folder(path, n))]
    rows = spark.createDataFrame([], RAW_SCHEMA)
    if own:
        rows = spark.read.schema(RAW_SCHEMA).parquet(*[batch_folder(path, n) for n in own])
    others = sorted(set(names) - set(own))
    if state and others:
        rows = rows.unionByName(merged_rows(spark, path, state).where(F.col(BATCH_COLUMN).isin(others)).select(RAW_COLUMNS))
    return rows


def read_batch(spark: SparkSession, path: str, batch_id: str) -> DataFrame:
    return read_batches(spark, path, [batch_id])


def new_rows(batch: DataFrame, history: DataFrame) -> DataFrame:
    """Rows of `batch` that the history does not hold, each once; NULLs compare as equal.

    Rows are compared in all columns, since a later version of the same id must still come in. Both
    sides are grouped together: copies collapse before the one shuffle, so no group of copies is
    too large. The plan is the same for batches of any size.
    """
    batch, history = conform(batch), conform(history)
    both = batch.withColumn("held", F.lit(False)).unionByName(history.withColumn("held", F.lit(True)))
    return both.groupBy(RAW_COLUMNS).agg(F.bool_or("held").alias("held")).where("NOT held").drop("held")
