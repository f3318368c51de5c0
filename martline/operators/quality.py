"""Duplicate-key data-quality checks and their reports.

* ``duplicate_key_groups``: number of (key + load time) groups holding more
  than one row, counting the *first* key column (a NULL first key never
  counts). Versions of a key are legal; two copies within one load are not.
* ``key_check_report``: one report row per (table, rule), zero results
  included, built as one union plan and run as one job.
* ``file_duplicates``: per dataset in a folder, the first-column values seen
  more than once, with their count.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K

KEY_REPORT_SCHEMA = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("environment", T.StringType()),
        T.StructField("dm_table", T.StringType()),
        T.StructField("validation_rule", T.StringType()),
        T.StructField("validation_result", T.LongType()),
    ]
)

FILE_REPORT_SCHEMA = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("excel_source", T.StringType()),
        T.StructField("pk_num", T.StringType()),
        T.StructField("number_of_dublicates", T.LongType()),
    ]
)


def date_column(run_date: str | Column | None) -> Column:
    if run_date is None:
        return F.date_format(F.current_date(), "yyyy-MM-dd")
    return F.lit(run_date) if isinstance(run_date, str) else run_date


def duplicate_key_groups(
    df: DataFrame, keys: Sequence[str], load_ts: str | None = K.LOAD_TS, out: str = "validation_result"
) -> DataFrame:
    """One-row DataFrame: number of duplicated (keys, load_ts) groups."""
    group = list(keys) + ([load_ts] if load_ts else [])
    first = keys[0]
    dup = df.groupBy(*group).agg(F.count(first).alias("__n")).where(F.col("__n") > 1)
    return dup.agg(F.count(first).alias(out))


def null_key_rows(df: DataFrame, keys: Sequence[str], out: str = "validation_result") -> DataFrame:
    """One-row DataFrame: rows whose first key column is NULL (they escape
    ``duplicate_key_groups``)."""
    return df.agg(F.count(F.when(F.col(keys[0]).isNull(), F.lit(1))).alias(out))


# rule name -> (df, keys, load_ts) -> one-row DataFrame with ``validation_result``
RULES: dict[str, Callable[[DataFrame, Sequence[str], str | None], DataFrame]] = {
    K.RULE_DUPLICATE_CHECK: lambda df, keys, ts: duplicate_key_groups(df, keys, ts),
    "null_key_check": lambda df, keys, ts: null_key_rows(df, keys),
}


@dataclass(frozen=True)
class CheckedTable:
    """A table under check: how to read it and its business key."""

    name: str
    df: DataFrame
    keys: tuple[str, ...]
    load_ts: str | None = K.LOAD_TS


def registry_resolver(
    tables: Mapping[str, DataFrame],
    keys: Iterable[tuple[str, Sequence[str]]] = K.MART_TABLE_KEYS,
    load_ts: str = K.LOAD_TS,
) -> Callable[[str], CheckedTable]:
    """Resolve table names to checks using a key registry.

    ``tables`` maps names to DataFrames (e.g. ``spark.table`` results). A
    name missing from either the registry or ``tables`` raises ``KeyError``.
    """
    registry = {name: tuple(k) for name, k in keys}

    def resolve(name: str) -> CheckedTable:
        if name not in registry:
            raise KeyError(f"no key definition for table {name!r}")
        if name not in tables:
            raise KeyError(f"table {name!r} is not available")
        return CheckedTable(name, tables[name], registry[name], load_ts)

    return resolve


def environment_resolver(
    environments: Mapping[str, Mapping[str, DataFrame]],
    environment: str,
    keys: Iterable[tuple[str, Sequence[str]]] = K.MART_TABLE_KEYS,
    load_ts: str = K.LOAD_TS,
) -> Callable[[str], CheckedTable]:
    """Resolve table names within one environment's tables (``environments``: name -> tables).

    The same rules then run on the tables of whichever environment is chosen; an unknown one raises ``KeyError``.
    """
    if environment not in environments:
        raise KeyError(f"unknown environment {environment!r}")
    return registry_resolver(environments[environment], keys, load_ts)


def key_check_report(
    tables_rules: Iterable[Mapping[str, Sequence[str]]],
    resolve: Callable[[str], CheckedTable],
    environment: str,
    run_date: str | None = None,
) -> DataFrame:
    """Run the configured rules and return the report.

    ``tables_rules`` is a list of ``{table: [rule, ...]}`` entries. Every
    (table, known rule) pair gives one row; unknown rules are skipped.
    ``resolve`` maps a table name to its ``CheckedTable`` and must raise for
    unknown tables. All checks form one union plan (one Spark job).
    """
    parts = []
    for entry in tables_rules:
        for table, rules in entry.items():
            checked = resolve(table)
            for rule in rules:
                fn = RULES.get(rule)
                if fn is None:
                    continue
                res = fn(checked.df, checked.keys, checked.load_ts)
                parts.append(
                    res.select(
                        date_column(run_date).alias("date"),
                        F.lit(environment).alias("environment"),
                        F.lit(table).alias("dm_table"),
                        F.lit(rule).alias("validation_rule"),
                        F.col("validation_result").cast("bigint").alias("validation_result"),
                    )
                )
    if not parts:
        spark = SparkSession.getActiveSession()
        return spark.createDataFrame([], KEY_REPORT_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def file_duplicates(
    rows: DataFrame,
    source: str,
    key: str,
    run_date: str | None = None,
    keep_null_keys: bool = False,
) -> DataFrame:
    """Report first-column values seen more than once per source.

    ``rows`` has one row per record with its ``source`` id and ``key``
    (first column). Clean sources give no row. NULL keys are left out
    unless ``keep_null_keys``; count them with ``null_key_rows``.
    """
    r = rows if keep_null_keys else rows.where(F.col(key).isNotNull())
    dup = r.groupBy(source, key).agg(F.count(F.lit(1)).alias("number_of_dublicates"))
    return dup.where(F.col("number_of_dublicates") > 1).select(
        date_column(run_date).alias("date"),
        F.col(source).alias("excel_source"),
        F.col(key).cast("string").alias("pk_num"),
        F.col("number_of_dublicates").cast("bigint"),
    )
