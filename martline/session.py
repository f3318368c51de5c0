"""Spark session defaults and the shared checkpoint folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",  # windows and Python cost far more a byte than scans
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "martline", shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE and skew-join handling on."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, read from the session; an error if it is unset."""
    sc = spark.sparkContext
    conf = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def cut_lineage(df: DataFrame, dealt_by: str | None = None) -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder
    and return a DataFrame reading it.

    Used where one derived table feeds several consumers: they read the
    written files instead of re-running the plan, and a lost executor costs a
    re-read, not a recomputation from the sources. Writing a table computes
    ``df`` once; an eager ``checkpoint()`` would compute it twice (once to
    count, once to save) unless it were also cached.

    ``dealt_by``: a column in whose buckets the table is stored, as many as a
    shuffle has partitions, so that consumers keyed by it read it without a
    shuffle. If ``df`` is dealt by it already, each task writes its own buckets.
    """
    spark = df.sparkSession
    path = _table_path(spark)
    if (written := _WRITTEN.get()) is not None:
        written.append(path)
    if dealt_by:
        return _dealt(df, dealt_by, path)
    df.write.parquet(path)
    return spark.read.parquet(path)


@contextmanager
def dealt_table(df: DataFrame, key: str) -> Iterator[DataFrame]:
    """``df`` stored in the shared checkpoint folder in buckets of ``key``, as many as a shuffle has partitions.

    Joins on ``key`` read it without a shuffle. Its files are deleted when the block ends.
    """
    spark = df.sparkSession
    path = _table_path(spark)
    try:
        yield _dealt(df, key, path)
    finally:
        _delete(spark, path)


def _table_path(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"


def _dealt(df: DataFrame, key: str, path: str) -> DataFrame:
    """``df`` written to ``path`` in buckets of ``key``. Spark writes buckets of named tables only, so the table has a name
    until it is read; its files are external and stay."""
    spark = df.sparkSession
    name = f"martline_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        df.write.format("parquet").bucketBy(buckets, key).option("path", path).saveAsTable(name)
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


#: Folders that ``cut_lineage`` writes inside a ``scratch_tables`` block.
_WRITTEN: ContextVar[list[str] | None] = ContextVar("written", default=None)


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that ``cut_lineage`` writes inside the block when it ends (also when it fails)."""
    written: list[str] = []
    token = _WRITTEN.set(written)
    try:
        yield
    finally:
        _WRITTEN.reset(token)
        for path in written:
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
