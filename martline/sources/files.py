"""Folder of tabular files as one distributed read.

Every entry of the folder whose name ends in ``.csv`` is one dataset: a
single file (``orders.csv``) or a folder of part files as Spark writes them
(``orders.csv/part-*.csv``). The dataset id is the entry's full name, so
``a.csv`` and ``a.xlsx`` never overwrite each other.

All datasets are read together; only the *first* column of each row is used,
by position, so datasets with different headers can share the scan (column
names come from one header; positions are what matter, and every file's own
header is skipped). Files are read by byte ranges: those where every line is a
record by the line-wise CSV reader, those with quoted values that hold line
feeds as ``csv_records`` describes. A large file is thus the work of many tasks.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import FILE_REPORT_SCHEMA, file_duplicates
from .csv_records import file_lines, spanning_files, spanning_first_values


class FolderError(ValueError):
    """The folder does not exist."""


def first_column_rows(spark: SparkSession, folder: str) -> DataFrame | None:
    """(source, pk) per data row of every ``.csv`` dataset in ``folder``.

    Returns ``None`` when the folder holds no CSV data; raises
    ``FolderError`` when it does not exist.
    """
    try:
        raw = (
            spark.read.option("header", True)
            .option("inferSchema", False)
            .option("escape", '"')  # doubled quotes
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.csv")
            .csv(folder)
        )
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            raise FolderError(f"path does not exist: {folder}") from e
        if "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise
    if not raw.columns:
        return None
    # the header may hold any characters, so the column is taken by place
    raw = raw.toDF(*[f"c{i}" for i in range(len(raw.columns))])
    rows = raw.select(F.col("_metadata.file_path").alias("file"), F.col("c0").cast("string").alias("pk"))
    lines = file_lines(spark, folder)
    spanning = spanning_files(lines)
    if spanning:
        by_line = rows.where(~F.col("file").isin(spanning))
        rows = by_line.unionByName(spanning_first_values(lines, spanning).withColumnRenamed("value", "pk"))
    # the folder's qualified path is a prefix of every file's path
    location = spark._jvm.org.apache.hadoop.fs.Path(folder)
    location = location.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(location)
    base = "^[^:/]*:?/*" + re.escape(location.toUri().getPath().strip("/"))
    # file_path is a URI (a space is %20); decode it, keeping a literal '+'
    path = F.url_decode(F.regexp_replace("file", r"\+", "%2B"))
    rows = rows.select(F.regexp_extract(path, base + "/([^/]+)", 1).alias("source"), "pk")
    return rows.where(F.col("source").endswith(".csv"))  # a plain folder below is no dataset


def folder_duplicates(spark: SparkSession, folder: str, run_date: str | None = None) -> DataFrame:
    """Duplicate first-column values per dataset in ``folder``.

    An empty folder, or one without CSV data, gives an empty report.
    """
    rows = first_column_rows(spark, folder)
    if rows is None:
        return spark.createDataFrame([], FILE_REPORT_SCHEMA)
    return file_duplicates(rows, "source", "pk", run_date)
