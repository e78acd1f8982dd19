"""Tables kept in parts, of which a change writes only those it touches.

Rows are dealt by a hash of their key to a fixed number of parts. Each write makes folders of its own below
`data`, one for each part that it has rows of, and then a manifest below `builds` that names the folders of
every part. A reader takes the newest manifest and reads whole builds; folders that a write did not touch are
named again, not written again. Replaced folders and manifests stay for a while, so whoever reads a build that
was current some writes ago can end.

`replace` gives parts new contents. `append` adds folders to parts; where `TIER` of one size class have
gathered in a part they are merged into one of the next class, so a part has few folders and a row is
rewritten about log(appends) times.

Manifests are small (a line for each folder) and read by the driver; nothing here lists data folders or
reads file footers. One writer at a time: a second one that began at the same build fails.
"""

import json
import time
from dataclasses import dataclass, field
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from divtide.session import empty

PARTS = 8  # that a table begins with, if it is not told how many
TIER = 8
# How long a build stays readable after it was replaced.
BUILD_SECONDS = 24 * 3600

Folder = tuple[str, int]  # below the table's root, and its size class


@dataclass(frozen=True)
class Build:
    number: int = 0
    parts: int = PARTS
    folders: dict[int, tuple[Folder, ...]] = field(default_factory=dict)
    notes: dict = field(default_factory=dict)

    def paths(self, parts: list[int] | None = None) -> list[str]:
        chosen = self.folders if parts is None else [p for p in parts if p in self.folders]
        return [folder for p in chosen for folder, _ in self.folders[p]]

    def changed(self, since: "Build | None") -> list[int]:
        """Parts whose folders are not those of an earlier build; all parts if there is none to compare with."""
        if since is None or since.parts != self.parts:
            return list(range(self.parts))
        return [p for p in range(self.parts) if self.folders.get(p) != since.folders.get(p)]

    def text(self) -> str:
        return json.dumps({"number": self.number, "parts": self.parts, "folders": self.folders, "notes": self.notes})

    @staticmethod
    def of_text(text: str) -> "Build":
        told = json.loads(text)
        folders = {int(p): tuple((f, level) for f, level in found) for p, found in told["folders"].items()}
        return Build(told["number"], told["parts"], folders, told["notes"])


class Files:
    """The few file operations that Spark's own readers and writers do not offer, on any Hadoop file system."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def at(self, path: str):
        where = self.jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.conf), where

    def exists(self, path: str) -> bool:
        files, where = self.at(path)
        return files.exists(where)

    def names(self, path: str) -> dict[str, float]:
        """Names below a folder with the seconds since they changed; none if there is no such folder."""
        files, where = self.at(path)
        if not files.exists(where):
            return {}
        now = time.time()
        return {s.getPath().getName(): now - s.getModificationTime() / 1000 for s in files.listStatus(where)}

    def read(self, path: str) -> str:
        files, where = self.at(path)
        stream = files.open(where)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> None:
        """A new file that readers see whole or not at all; fails if there is one of that name."""
        files, where = self.at(path)
        if files.exists(where):
            raise FileExistsError(path)
        draft = self.jvm.org.apache.hadoop.fs.Path(where.getParent(), f"_{uuid4().hex}")
        stream = files.create(draft, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if not files.rename(draft, where):
            files.delete(draft, False)
            raise FileExistsError(path)

    def delete(self, path: str) -> None:
        files, where = self.at(path)
        files.delete(where, True)


class PartTable:
    """A table in parts below the folder `root`, with rows of `schema` dealt by `keys`."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: list[str], parts: int = PARTS):
        self.spark, self.root, self.schema, self.keys = spark, root.rstrip("/"), schema, keys
        self.files = Files(spark)
        current = self.build()
        # A table keeps the number of parts that it has, until all of it is dealt anew.
        self.parts = current.parts if current else parts

    def deal(self, parts: int) -> None:
        """Sets the number of parts of what is written from now on; the next write must replace all rows."""
        self.parts = parts

    def numbers(self) -> list[int]:
        names = self.files.names(f"{self.root}/builds")
        return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json"))

    def build(self, number: int | None = None) -> Build | None:
        """The newest build, or the one of that number if it is still there."""
        numbers = self.numbers()
        if number is None:
            number = numbers[-1] if numbers else None
        if number not in numbers:
            return None
        return Build.of_text(self.files.read(f"{self.root}/builds/{number:010d}.json"))

    def part(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.parts)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """The parts that rows belong to: at most as many numbers as there are parts."""
        return sorted(r["part"] for r in rows.select(self.part().alias("part")).distinct().collect())

    def read(self, parts: list[int] | None = None, build: Build | None = None) -> DataFrame:
        """The rows of a build, the newest by default; with `parts`, only the folders of these are read."""
        build = build or self.build()
        return self._rows(build.paths(parts) if build else [])

    def _rows(self, folders: list[str]) -> DataFrame:
        if not folders:
            return empty(self.spark, self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.root}/{f}" for f in folders])

    def _write(self, rows: DataFrame, in_parts: bool = False) -> dict[int, str]:
        """Writes rows and returns the new folder of each part that has some.

        Rows `in_parts` come from folders of parts that are dealt alike: tasks that read these have few parts
        each, so nothing is shuffled.
        """
        name = f"data/{uuid4().hex}"
        dealt = rows.select(*self.schema.names, self.part().alias("part"))
        if not in_parts:
            # Tasks get whole small parts, and slices of large ones.
            dealt = self.spark.sql("SELECT /*+ REBALANCE(part) */ * FROM {dealt}", dealt=dealt)
        dealt.write.partitionBy("part").parquet(f"{self.root}/{name}")
        found = [n for n in self.files.names(f"{self.root}/{name}") if n.startswith("part=")]
        return {int(n.removeprefix("part=")): f"{name}/{n}" for n in found}

    def _commit(self, base: Build | None, folders: dict[int, tuple[Folder, ...]], notes: dict) -> Build:
        made = Build(base.number + 1 if base else 1, self.parts, folders, notes)
        self.files.create(f"{self.root}/builds/{made.number:010d}.json", made.text())
        return made

    def replace(
        self, rows: DataFrame, parts: list[int] | None = None, notes: dict | None = None, in_parts: bool = False
    ) -> Build:
        """Gives `parts` (all by default) the given rows in place of theirs; other parts keep their folders.

        `in_parts` says that the rows were read, and only projected, from a table with the same keys and parts.
        """
        base = self.build()
        parts = list(range(self.parts)) if parts is None else parts
        if base and base.parts != self.parts and len(parts) < self.parts:
            raise ValueError(f"{self.root} has {base.parts} parts, so {self.parts} can only be written together")
        written = self._write(rows, in_parts) if parts else {}
        if not set(written) <= set(parts):
            raise ValueError(f"rows of parts {sorted(set(written) - set(parts))}, which are not replaced")
        kept = {p: f for p, f in base.folders.items() if p not in set(parts)} if base and base.parts == self.parts else {}
        return self._commit(base, kept | {p: ((f, 0),) for p, f in written.items()}, notes or {})

    def append(self, rows: DataFrame, notes: dict | None = None) -> Build:
        """Adds rows, and merges folders where many of one size class have gathered."""
        base = self.build()
        folders = dict(base.folders) if base else {}
        for part, folder in self._write(rows).items():
            folders[part] = (*folders.get(part, ()), (folder, 0))
        while full := {(p, level) for p, found in folders.items() if (level := full_tier(found)) is not None}:
            merged = [f for p, level in full for f, of in folders[p] if of == level]
            written = self._write(self._rows(merged))
            for part, level in full:
                rest = tuple(x for x in folders[part] if x[1] != level)
                folders[part] = (*rest, (written[part], level + 1))
        return self._commit(base, folders, notes or {})

    def clean(self, seconds: float = BUILD_SECONDS) -> None:
        """Removes builds replaced longer ago than `seconds`, and data that no remaining build names."""
        ages = self.files.names(f"{self.root}/builds")
        numbers = self.numbers()
        # A build was replaced when the next one was made.
        for number, following in zip(numbers, numbers[1:]):
            if ages[f"{following:010d}.json"] > seconds:
                self.files.delete(f"{self.root}/builds/{number:010d}.json")
        named = {f for n in self.numbers() for f in self.build(n).paths()}
        for write, age in self.files.names(f"{self.root}/data").items():
            if age <= seconds:
                continue  # perhaps of a write that is not committed yet
            parts = [p for p in self.files.names(f"{self.root}/data/{write}") if p.startswith("part=")]
            unnamed = [p for p in parts if f"data/{write}/{p}" not in named]
            if len(unnamed) == len(parts):
                self.files.delete(f"{self.root}/data/{write}")
            else:
                for p in unnamed:
                    self.files.delete(f"{self.root}/data/{write}/{p}")

    def publish(self, table: str, build: Build | None = None) -> DataFrame:
        """Makes a build what the catalog name `table` shows, whole and at once.

        The build becomes a table of its own, partitioned by part, whose partitions lie in the folders of the
        build; `table` is a view that is then pointed at it. For builds whose parts have one folder each.
        """
        build = build or self.build()
        database, name = table.split(".")
        own = f"{table}__{build.number}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
        self.spark.sql(f"DROP TABLE IF EXISTS {own}")
        location = f"{self.root}/published/{build.number}"
        self.spark.sql(f"CREATE TABLE {own} ({columns}, part INT) USING parquet PARTITIONED BY (part) LOCATION '{location}'")
        places = [f"PARTITION (part = {p}) LOCATION '{self.root}/{f}'" for p, ((f, _),) in build.folders.items()]
        if places:
            self.spark.sql(f"ALTER TABLE {own} ADD {' '.join(places)}")
        drop_if_table(self.spark, table)
        named = ", ".join(f"`{c}`" for c in self.schema.names)
        self.spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT {named} FROM {own}")
        # Tables of builds that are gone have nothing left to show.
        current = set(self.numbers())
        for row in self.spark.sql(f"SHOW TABLES IN {database} LIKE '{name}__*'").collect():
            number = row["tableName"].rsplit("__", 1)[1]
            if number.isdigit() and int(number) not in current:
                self.spark.sql(f"DROP TABLE IF EXISTS {database}.{row['tableName']}")
        return self.spark.table(table)


def drop_if_table(spark: SparkSession, name: str) -> None:
    """Makes room for a view where a table has its name."""
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")


def full_tier(folders: tuple[Folder, ...]) -> int | None:
    levels = [level for _, level in folders]
    return next((level for level in sorted(set(levels)) if levels.count(level) >= TIER), None)
