"""End-to-end jobs (E1-E5): read staging, build, compare, write.

Targets are paths (Parquet) or catalog tables (``is_table=True``). Each
incremental load reads the target's current state and appends only new or
changed rows with one load timestamp per run. A run that fails leaves the
target unchanged, and running a load twice in a row
appends nothing the second time (but for rows with a NULL key, which match no
stored row, as in the source). Loads into a path commit through a ledger: of two
runs at once the second compares again with what the first appended, and a
repeated run id appends nothing.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..operators import quality
from ..operators.changes import new_or_changed
from ..operators.versions import current_state
from ..session import cut_lineage, scratch_tables
from ..sources import sinks
from ..sources.files import folder_duplicates
from ..sources.state import checked_loads
from ..sources.store import Commit, Ledger
from . import shipment_mart, shipment_points, variability_mart


def read_target(spark: SparkSession, target: str, is_table: bool = False) -> DataFrame | None:
    """The mart as stored, or ``None`` before its first load."""
    if is_table:
        return spark.table(target) if spark.catalog.tableExists(target) else None
    try:
        return sinks.read_current(spark, target)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def _changes(rows: DataFrame, stored: DataFrame | None, keys: Sequence[str], columns: Sequence[str], partition_by):
    """The new or changed ``rows``, and an observation of their number.

    The rows are counted by the write itself, so the mart is not read again. A partitioned mart gathers the rows
    of each partition value first (a hot value is split by AQE), so a run writes few files.
    """
    changes = rows if stored is None else new_or_changed(rows, current_state(stored, list(keys)), keys, columns)
    if partition_by:
        changes = changes.hint("rebalance", *partition_by)
    counted = Observation()
    return changes.observe(counted, F.count(F.lit(1)).alias("rows")), counted


def _incremental(spark, rows: DataFrame, target: str, keys: Sequence[str], columns: Sequence[str], run_ts,
                 is_table: bool, partition_by=None, run_id: str | None = None) -> int:
    """Append the new or changed ``rows``; return how many this run appended.

    A path's run compares with the target at one version, writes its changes aside and claims the next version. If
    another run has claimed that meanwhile, it compares again. A run whose id is in the ledger appends nothing; its
    rows are there, or are brought there now if it was killed before. (A table's appends are atomic but unguarded.)
    """
    def now():
        return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)

    if is_table:
        changes, counted = _changes(rows, read_target(spark, target, True), keys, columns, partition_by)
        sinks.append_versioned(changes, target, columns, run_ts or now(), partition_by=partition_by, is_table=True)
        return counted.get["rows"]
    run_id = run_id or uuid.uuid4().hex
    ledger = Ledger(spark, target)
    while True:
        known = ledger.settle()
        if run_id in {c.run_id for c in known}:
            return 0
        version = known[-1].version if known else 0
        stored = read_target(spark, target)
        changes, counted = _changes(rows, stored, keys, columns, partition_by)
        ledger.drop(run_id)
        sinks.append_versioned(changes, ledger.staged(run_id), columns, run_ts or now(), partition_by=partition_by)
        n = counted.get["rows"]
        if not n and stored is not None:
            ledger.drop(run_id)
            return 0
        commit = Commit(version + 1, run_id, n)
        if ledger.claim(commit):
            ledger.publish(commit)
            return n


def load_shipment_mart(spark: SparkSession, src: Mapping[str, DataFrame], target: str, run_ts=None,
                       is_table: bool = False, resolve_dims: bool = True, client_in_join: bool = False,
                       run_id: str | None = None, made: Mapping[str, DataFrame] | None = None) -> int:
    """E1: append new or changed shipment rows; returns their number.

    ``made``: the sides of the star, if several loads share them (``shipment_mart.stored_sides``).
    """
    rows = shipment_mart.enriched(src, resolve_dims, client_in_join, made)
    return _incremental(spark, rows, target, [shipment_mart.KEY], shipment_mart.COLUMNS, run_ts, is_table, run_id=run_id)


def load_variability_mart(spark: SparkSession, src: Mapping[str, DataFrame], target: str, run_ts=None,
                          is_table: bool = False, resolve_dims: bool = True, client_in_join: bool = False,
                          run_id: str | None = None) -> int:
    """E2: append new or changed variability rows; returns their number.

    Day cells feed the base rows and both leaf aggregates, so they are
    written once and read by all of them; the load deletes them at its end.
    The mart is partitioned by year on disk so readers of a period prune files.
    """
    with scratch_tables(spark):
        day = cut_lineage(variability_mart.day_cells(src, resolve_dims, client_in_join))
        rows = variability_mart.mart_rows(day)
        return _incremental(spark, rows, target, variability_mart.KEYS, variability_mart.COLUMNS, run_ts, is_table,
                            partition_by=["year"], run_id=run_id)


def rebuild_shipment_points(tvst: DataFrame, target: str, run_ts=None, is_table: bool = False) -> None:
    """E3: replace the shipping-point dimension as a whole; read a path by ``read_target``."""
    sinks.full_refresh(shipment_points.rows(tvst), target, shipment_points.COLUMNS, run_ts, is_table=is_table)


def _reported(report: DataFrame, report_path: str | None, run_id: str | None) -> DataFrame:
    """Append ``report`` to ``report_path`` if given; the checks run once (the rows are stored, then returned)."""
    if report_path:
        report = cut_lineage(report)
        sinks.append_report(report, report_path, run_id=run_id)
    return report


def run_key_checks(tables_rules: Iterable[Mapping[str, Sequence[str]]], resolve, environment: str,
                   report_path: str | None = None, run_date: str | None = None, run_id: str | None = None) -> DataFrame:
    """E4: duplicate-key checks over many tables; appended to ``report_path`` if given (once for each ``run_id``)."""
    return _reported(quality.key_check_report(tables_rules, resolve, environment, run_date), report_path, run_id)


def run_stored_key_checks(spark: SparkSession, tables: Mapping[str, str], state: str, environment: str,
                          keys: Iterable[tuple[str, Sequence[str]]] = K.MART_TABLE_KEYS, report_path: str | None = None,
                          run_date: str | None = None, run_id: str | None = None) -> DataFrame:
    """E4 over stored tables (name -> path) with a state folder: only loads that are new since the last check are read."""
    registry, parts = dict(keys), []
    for name, path in tables.items():
        if name not in registry:
            raise KeyError(f"no key definition for table {name!r}")
        loads, _ = checked_loads(spark, path, f"{state.rstrip('/')}/{name}", registry[name])
        parts.append(loads.agg(F.sum("groups").alias("validation_result")).select(
            quality.date_column(run_date).alias("date"), F.lit(environment).alias("environment"),
            F.lit(name).alias("dm_table"), F.lit(K.RULE_DUPLICATE_CHECK).alias("validation_rule"), "validation_result"))
    return _reported(reduce(DataFrame.unionByName, parts), report_path, run_id)


def run_file_checks(spark: SparkSession, folder: str, report_path: str | None = None,
                    run_date: str | None = None, run_id: str | None = None) -> DataFrame:
    """E5: duplicate first-column values per dataset in a folder; appended as by ``run_key_checks``."""
    return _reported(folder_duplicates(spark, folder, run_date), report_path, run_id)
