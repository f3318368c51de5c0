"""Writers: versioned append, full refresh, report append.

Appends go through Spark's file commit protocol: a failed or retried task
leaves no partial output. Loads append through a ledger (``store.Ledger``), so
two runs at once, a killed run or a repeated one never append a row twice. A full refresh writes
the new rows to a folder of their own and makes it current when it is complete
(``store.Versions``); ``read_current`` reads what is current.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import LOAD_TS
from .store import Commit, Folder, Ledger, Versions


def stamp(df: DataFrame, run_ts: dt.datetime | str | Column | None = None, col: str = LOAD_TS) -> DataFrame:
    """Add the load timestamp (one value per run; default: now)."""
    if run_ts is None:
        ts = F.current_timestamp().cast("timestamp_ntz")
    elif isinstance(run_ts, Column):
        ts = run_ts
    else:
        ts = F.lit(run_ts).cast("timestamp_ntz")
    return df.withColumn(col, ts)


def _writer(df: DataFrame, mode: str, fmt: str, partition_by: Sequence[str] | None):
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w


def append_versioned(
    df: DataFrame,
    target: str,
    columns: Sequence[str],
    run_ts=None,
    fmt: str = "parquet",
    partition_by: Sequence[str] | None = None,
    is_table: bool = False,
) -> None:
    """Append ``columns`` of ``df`` plus the load timestamp to ``target``.

    ``target`` is a path (``is_table=False``) or a catalog table name.
    Appending to a target that the same plan reads is safe.
    """
    out = stamp(df.select(*columns), run_ts)
    w = _writer(out, "append", fmt, partition_by)
    if is_table:
        w.saveAsTable(target)
    else:
        w.save(target)


PREVIOUS = "martline.previous_location"


def read_current(spark: SparkSession, target: str, fmt: str = "parquet") -> DataFrame:
    """The rows of a refreshed path (or of a plain folder): its current version, whole."""
    return spark.read.format(fmt).load(Versions(spark, target).current() or target)


def full_refresh(
    df: DataFrame, target: str, columns: Sequence[str], run_ts=None, fmt: str = "parquet", is_table: bool = False,
    grace_seconds: float = 3600,
) -> None:
    """Replace ``target`` with ``df``; a run that fails or is killed leaves the old rows or the new ones, never less.

    The new rows go to a fresh folder. For a path, one marker file then makes it current and readers resolve it by
    ``read_current``; a catalog table is pointed at it. The version before stays for one run at least, and a path's old
    versions for ``grace_seconds``, for readers that have begun.
    """
    out = stamp(df.select(*columns), run_ts)
    spark = df.sparkSession
    if not is_table:
        versions = Versions(spark, target)
        name = versions.fresh()
        out.write.format(fmt).save(versions.place(name))
        versions.publish(name)
        versions.clean(grace_seconds=grace_seconds)
        return
    if not spark.catalog.tableExists(target):
        _writer(out, "errorifexists", fmt, None).saveAsTable(target)
        return
    detail = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {target}").collect()}
    old = detail["Location"].rstrip("/")
    older = [r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {target}").collect() if r["key"] == PREVIOUS]
    fresh = f"{old.split('.version-')[0]}.version-{uuid.uuid4().hex}"
    out.write.format(fmt).save(fresh)
    spark.sql(f"ALTER TABLE {target} SET LOCATION '{fresh}'")
    spark.sql(f"ALTER TABLE {target} SET TBLPROPERTIES ('{PREVIOUS}' = '{old}')")
    spark.catalog.refreshTable(target)
    for path in older:
        Folder(spark, path).delete("")


def append_report(df: DataFrame, path: str, fmt: str = "csv", run_id: str | None = None) -> None:
    """Append report rows; CSV part files each carry a header. A run id that the report's ledger holds appends nothing."""
    spark = df.sparkSession
    ledger, run_id = Ledger(spark, path), run_id or uuid.uuid4().hex
    if run_id in {c.run_id for c in ledger.settle()}:
        return
    ledger.drop(run_id)
    w = df.write.format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    w.save(ledger.staged(run_id))
    while True:
        known = ledger.settle()
        if run_id in {c.run_id for c in known}:  # the same run, begun twice, was faster elsewhere
            return
        commit = Commit(known[-1].version + 1 if known else 1, run_id, -1)
        if ledger.claim(commit):
            ledger.publish(commit)
            return
