"""Sets of named tables under one directory, in place of a workbook of sheets.

Every write puts its tables in a folder of its own and then, last, one small
manifest that names the files of the whole set. A reader follows the newest
manifest, so it sees all tables of a write or none of them, and a write that
fails leaves what was there. Two writers can't both publish the same version.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping, Sequence
from urllib.parse import quote

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from verbamark.operators.candidates import to_long
from verbamark.schemas import wide_schema

TOTAL = "Total"
BY_SYSTEM = "by_system"
JUDGED = "judged_by_system"
_MANIFEST = "manifest-"


class TableExists(PySparkException, ValueError):
    """A table of that name is in the store already."""


class WriteConflict(RuntimeError):
    """Another writer published a version meanwhile."""


class PartitionedBy:
    """A table to be written in a folder per value of one column."""

    def __init__(self, df: DataFrame, column: str) -> None:
        self.df, self.column = df, column


class TableStore:
    """The tables of ``directory``, replaced all together."""

    def __init__(self, spark: SparkSession, directory: str) -> None:
        self.spark, self.directory = spark, directory.rstrip("/")
        self._hadoop, self._conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
        self._files = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._hadoop.Path(f"{self.directory}/{name}" if name else self.directory)

    def _manifests(self) -> list[int]:
        if not self._files.exists(self._path("")):
            return []
        names = [status.getPath().getName() for status in self._files.listStatus(self._path(""))]
        return sorted(int(n.removeprefix(_MANIFEST).removesuffix(".json")) for n in names
                      if n.startswith(_MANIFEST) and n.endswith(".json"))

    def _tables(self, version: int) -> dict[str, str]:
        stream = self._files.open(self._path(f"{_MANIFEST}{version:012d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def version(self) -> int:
        """The newest version, 0 for an empty store."""
        return max(self._manifests(), default=0)

    def names(self) -> list[str]:
        return sorted(self._tables(self.version())) if self.version() else []

    def path(self, name: str) -> str:
        version = self.version()
        tables = self._tables(version) if version else {}
        if name not in tables:
            raise FileNotFoundError(f"no table {name!r} in {self.directory}")
        return f"{self.directory}/{tables[name]}"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def write(self, tables: Mapping[str, DataFrame | PartitionedBy], *, append: bool = False) -> int:
        """Add the tables, or replace those of the same name, in one step; the new version's number.

        With ``append`` the store must exist and none of the names be in it.
        """
        before = self.version()
        if append and not before:
            raise FileNotFoundError(f"no table store at {self.directory}")
        kept = self._tables(before) if before else {}
        if append and (there := sorted(set(tables) & set(kept))):
            raise TableExists(f"tables {there} are in {self.directory} already")
        folder = f"version-{uuid.uuid4().hex}"
        for name, table in tables.items():
            kept[name] = f"{folder}/{quote(name, safe='')}"
            if isinstance(table, PartitionedBy):
                # gathered by value, so that not every task writes a file for each; large ones are split again
                rows = table.df.hint("rebalance", table.column)
                rows.write.partitionBy(table.column).parquet(f"{self.directory}/{kept[name]}")
            else:
                table.write.parquet(f"{self.directory}/{kept[name]}")
        self._publish(before + 1, kept)
        return before + 1

    def _publish(self, version: int, tables: dict[str, str]) -> None:
        draft, final = self._path(f".{uuid.uuid4().hex}"), self._path(f"{_MANIFEST}{version:012d}.json")
        stream = self._files.create(draft, False)
        try:
            stream.write(json.dumps(tables, ensure_ascii=True).encode())
        finally:
            stream.close()
        context = self._hadoop.FileContext.getFileContext(self._files.makeQualified(final).toUri(), self._conf)
        never_over = self.spark.sparkContext._gateway.new_array(getattr(self._hadoop, "Options$Rename"), 0)
        try:
            context.rename(self._files.makeQualified(draft), self._files.makeQualified(final), never_over)
        except Exception as e:
            self._files.delete(draft, False)
            if "FileAlreadyExists" in str(e):
                raise WriteConflict(f"version {version} of {self.directory} was published by another writer") from e
            raise

    def vacuum(self, keep: int = 1, older_than: float = 86_400.0) -> None:
        """Delete what only versions before the last ``keep`` used, and what failed writes left.

        Folders written less than ``older_than`` seconds ago stay, as a writer
        may not have published them yet or a reader still hold them.
        """
        versions = self._manifests()
        for version in versions[:-keep]:
            self._files.delete(self._path(f"{_MANIFEST}{version:012d}.json"), False)
        used = {path.split("/")[0] for v in versions[-keep:] for path in self._tables(v).values()}
        for status in self._files.listStatus(self._path("")) if versions else ():
            name = status.getPath().getName()
            if (name.startswith("version-") and name not in used
                    and status.getModificationTime() / 1000 <= time.time() - older_than):
                self._files.delete(status.getPath(), True)


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return TableStore(spark, directory).read(name)


def read_candidates(spark: SparkSession, path: str, systems: Sequence[str],
                    fmt: str = "parquet", **options: str) -> DataFrame:
    """A wide candidate table under a declared schema, columns matched by name."""
    if fmt == "csv":
        # quoted fields may hold line feeds, and "" is a text while nothing is null
        options = {"header": "true", "multiLine": "true", "escape": '"',
                   "emptyValue": "", "nullValue": "\u0000", "enforceSchema": "false", **options}
    return spark.read.schema(wide_schema(systems)).options(**options).format(fmt).load(path)


def read_total(spark: SparkSession, directory: str, systems: Sequence[str]) -> DataFrame:
    """The wide table of a store under its declared schema."""
    return read_candidates(spark, TableStore(spark, directory).path(TOTAL), systems)


def write_candidates(wide: DataFrame, long: DataFrame, directory: str) -> None:
    """The wide table as ``Total``, the long one partitioned by system.

    A read of one system then touches that system's files only.
    """
    store = TableStore(wide.sparkSession, directory)
    store.write({TOTAL: wide, BY_SYSTEM: PartitionedBy(long, "system")})


def _by_system(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """Systems as they were named: left to itself Spark would take 01 for the number 1."""
    path = TableStore(spark, directory).path(name)
    found = spark.read.parquet(path).schema
    declared = StructType([StructField(f.name, StringType()) if f.name == "system" else f for f in found])
    return spark.read.schema(declared).parquet(path)


def read_by_system(spark: SparkSession, directory: str) -> DataFrame:
    """The long table with its systems as they were named."""
    return _by_system(spark, directory, BY_SYSTEM)


def read_system(spark: SparkSession, directory: str, system: str) -> DataFrame:
    """One system's rows of the table ``write_candidates`` partitioned."""
    return read_by_system(spark, directory).where(F.col("system") == system)


def judged_tables(wide: DataFrame, exported: DataFrame, systems: Sequence[str]) -> PartitionedBy:
    """The flat judgements of all systems beside their texts, one join and one write for all of them."""
    rows = to_long(wide, systems).join(exported, ["seg_id", "system"], "left")
    return PartitionedBy(rows.select("seg_id", "source", "reference", "system", "text", "error_type", "severity",
                                     "explanation", "score"), "system")


def read_judged(spark: SparkSession, directory: str, system: str) -> DataFrame:
    """The flat table of one system, its texts in a column of its name."""
    rows = _by_system(spark, directory, JUDGED).where(F.col("system") == system)
    return rows.select("seg_id", "source", "reference", F.col("text").alias(system), "error_type", "severity",
                       "explanation", "score")


def _store_of(tables: Mapping[str, DataFrame | PartitionedBy], directory: str) -> TableStore:
    some = next(iter(tables.values()))
    return TableStore((some.df if isinstance(some, PartitionedBy) else some).sparkSession, directory)


def write_tables(tables: Mapping[str, DataFrame | PartitionedBy], directory: str) -> None:
    """Write the tables under their names, replacing those that exist, all at once or not at all."""
    if tables:
        _store_of(tables, directory).write(tables)


def append_tables(tables: Mapping[str, DataFrame | PartitionedBy], directory: str) -> None:
    """Add new tables to an existing store; neither the store nor a name is replaced."""
    if tables:
        _store_of(tables, directory).write(tables, append=True)
