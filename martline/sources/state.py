"""Stored current state of the staging tables, carried on by new files only.

For each staging table a state folder holds the newest row per key (tombstones included, so that a late older load
cannot bring a deleted key back) and the list of files it was made from: the high-water mark. A load lists the staging folder, reads the files
that are not in the list, takes the newest of these and the state per key, and publishes the result as the next
version of the state (``store.Versions``), rows and list together. Files that arrive late, or out of order, are new
files like others. The work grows with the new files and the keys, not with the history.

A state is a staging table itself: resolving it gives what resolving the whole history gives. Staging files are
appended and never rewritten; files that go (compaction of old loads) do no harm. Two loads at once carry the same state
on; the version published last stays, and a file that it did not see is new to the next load.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import LOAD_TS
from ..plans.actual import VERSIONED, Versioned
from .store import Folder, Versions


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Paths of the Parquet files below ``path``, hidden ones left out."""
    folder = Folder(spark, path)
    if not folder.exists():
        return []
    root = folder.fs.makeQualified(folder.at()).toString().rstrip("/")
    found, names = folder.fs.listFiles(folder.at(), True), []
    while found.hasNext():
        name = found.next().getPath().toString()
        if name.endswith(".parquet") and not any(p.startswith(("_", ".")) for p in name[len(root) :].split("/")):
            names.append(name)
    return sorted(names)


def advance(spark: SparkSession, source: str, state: str, table: Versioned) -> tuple[DataFrame, list[str]]:
    """(the state with all files of ``source``, the files that were read for it)."""
    versions = Versions(spark, state)
    current = versions.current()
    seen = {r["file"] for r in spark.read.parquet(f"{current}/files").collect()} if current else set()
    new = [f for f in data_files(spark, source) if f not in seen]
    if not new and current:
        return spark.read.parquet(f"{current}/rows"), []
    if not new:
        raise FileNotFoundError(f"no staging files in {source}")
    rows = table.newest(spark.read.option("basePath", source).parquet(*new))
    if current:
        rows = table.newest(spark.read.parquet(f"{current}/rows").unionByName(rows, allowMissingColumns=True))
    name = versions.fresh()
    rows.write.parquet(f"{versions.place(name)}/rows")
    files = spark.createDataFrame([(f,) for f in sorted(seen.union(new))], "file string")
    files.coalesce(1).write.parquet(f"{versions.place(name)}/files")
    versions.publish(name)
    versions.clean()
    return spark.read.parquet(f"{versions.place(name)}/rows"), new


class StagingState(Mapping):
    """Staging tables by name, each its state carried on by what is new below ``staging`` when it is first asked for."""

    def __init__(self, spark: SparkSession, staging: str, state: str):
        self.spark, self.staging, self.state = spark, staging.rstrip("/"), state.rstrip("/")
        self._read: dict[str, DataFrame] = {}
        #: Files read by this load, by table.
        self.new_files: dict[str, list[str]] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._read:
            table = VERSIONED[name]
            self._read[name], self.new_files[name] = advance(self.spark, f"{self.staging}/{name}", f"{self.state}/{name}", table)
        return self._read[name]

    def __iter__(self):
        return iter(VERSIONED)

    def __len__(self) -> int:
        return len(VERSIONED)


def _groups_by_load(df: DataFrame, keys: Sequence[str], load_ts: str) -> DataFrame:
    """(load_ts, groups): duplicated key groups of every load, zero included."""
    per_key = df.groupBy(load_ts, *keys).agg(F.count(keys[0]).alias("n"))
    return per_key.groupBy(load_ts).agg(F.count(F.when(F.col("n") > 1, F.col(keys[0]))).alias("groups"))


def checked_loads(spark: SparkSession, source: str, state: str, keys: Sequence[str],
                  load_ts: str = LOAD_TS) -> tuple[DataFrame, list[str]]:
    """(duplicated key groups of every load of a stored table, the files that were read for it).

    A duplicate is two rows of one key in one load, so loads checked before need no second scan: the state keeps each
    load's number of groups and the files seen. Only if a new file holds rows of a load checked before is that load
    read again, from all files.
    """
    versions = Versions(spark, state)
    current = versions.current()
    seen = {r["file"] for r in spark.read.parquet(f"{current}/files").collect()} if current else set()
    files = data_files(spark, source)
    new = [f for f in files if f not in seen]
    if not new:
        if current is None:
            raise FileNotFoundError(f"no files in {source}")
        return spark.read.parquet(f"{current}/rows"), []

    def read(names: list[str]) -> DataFrame:
        return spark.read.option("basePath", source).parquet(*names).select(load_ts, *keys)

    rows, was_read = read(new), new
    loads = rows.select(F.col(load_ts).alias("__load")).distinct()
    same = F.col(load_ts).eqNullSafe(F.col("__load"))
    before = spark.read.parquet(f"{current}/rows") if current else None
    if before is not None and not before.join(loads, same, "left_semi").isEmpty():
        rows, was_read = read(files).join(loads, same, "left_semi"), files
    counts = _groups_by_load(rows, keys, load_ts)
    if before is not None:
        counts = before.join(loads, same, "left_anti").unionByName(counts)
    name = versions.fresh()
    counts.write.parquet(f"{versions.place(name)}/rows")
    spark.createDataFrame([(f,) for f in files], "file string").coalesce(1).write.parquet(f"{versions.place(name)}/files")
    versions.publish(name)
    versions.clean()
    return spark.read.parquet(f"{versions.place(name)}/rows"), was_read
