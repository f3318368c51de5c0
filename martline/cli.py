"""Command line for the end-to-end jobs (run with ``python -m martline.cli`` or
``spark-submit``).

Staging tables are Parquet folders under ``--staging``, one per table, named
like the keys of ``sources.testdata.STAGING`` (``vttk``, ``vttp``, ``likp``,
...). Targets are Parquet folders (or catalog tables with ``--table``). The
session comes from ``SparkSession.builder``, so cluster settings (master,
``spark.checkpoint.dir``, shuffle partitions) are taken from spark-submit.

    shipment-mart      E1: append new or changed shipment rows
    variability-mart   E2: append new or changed variability rows
    shipment-points    E3: rebuild the shipping-point dimension
    key-check          E4: duplicate-key report over tables given as name=path
    file-check         E5: duplicate first-column values per CSV dataset in a folder
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from . import constants as K
from .operators import quality
from .plans import jobs
from .session import get_spark
from .sources.sinks import read_current
from .sources.state import StagingState
from .sources.testdata import STAGING


#: Report rows printed; ``--report`` keeps all of them.
REPORT_ROWS = 1000


class ParquetStaging(Mapping):
    """Staging tables stored as Parquet folders, read on first use."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._read: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in STAGING:
            raise KeyError(name)
        if name not in self._read:
            self._read[name] = read_current(self.spark, f"{self.root}/{name}")
        return self._read[name]

    def __iter__(self):
        return iter(STAGING)

    def __len__(self) -> int:
        return len(STAGING)


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="martline", description="logistics mart jobs on Spark")
    sub = p.add_subparsers(dest="job", required=True)
    for name in ("shipment-mart", "variability-mart", "shipment-points"):
        s = sub.add_parser(name)
        s.add_argument("--staging", required=True, help="folder with one Parquet folder per staging table")
        s.add_argument("--target", required=True, help="target path (or table name with --table)")
        s.add_argument("--table", action="store_true", help="target is a catalog table")
        s.add_argument("--run-ts", default=None, help="load timestamp (default: now)")
        s.add_argument("--run-id", default=None, help="a load or report that was committed under this id is not repeated")
        s.add_argument("--state", default=None, help="folder with the stored state of the staging tables; only new files are read")
        s.add_argument("--client-in-join", action="store_true",
                       help="join headers to items and stages on (client, shipment number)")
    k = sub.add_parser("key-check")
    k.add_argument("tables", nargs="+", help="tables to check (names from the key registry): name=path, or a name "
                                             "alone for the table in the environment's root folder")
    k.add_argument("--environment", default="prod", help="environment whose tables are checked")
    k.add_argument("--root", action="append", default=[], metavar="ENVIRONMENT=FOLDER",
                   help="folder with the Parquet tables of an environment (once each)")
    k.add_argument("--report", default=None, help="CSV report folder to append to")
    k.add_argument("--date", default=None)
    k.add_argument("--run-id", default=None)
    k.add_argument("--state", default=None, help="folder with the results of loads checked before; only new loads are read")
    f = sub.add_parser("file-check")
    f.add_argument("--folder", required=True)
    f.add_argument("--report", default=None)
    f.add_argument("--date", default=None)
    f.add_argument("--run-id", default=None)
    return p


def run(argv: Sequence[str], spark: SparkSession | None = None) -> DataFrame | int | None:
    """Run one job; returns the number of appended rows or the report."""
    args = _parser().parse_args(list(argv))
    spark = spark or get_spark(app=f"martline-{args.job}")
    if "staging" in args:
        src = StagingState(spark, args.staging, args.state) if args.state else ParquetStaging(spark, args.staging)
    if args.job == "shipment-mart":
        return jobs.load_shipment_mart(spark, src, args.target, args.run_ts,
                                       args.table, client_in_join=args.client_in_join, run_id=args.run_id)
    if args.job == "variability-mart":
        return jobs.load_variability_mart(spark, src, args.target, args.run_ts,
                                          args.table, client_in_join=args.client_in_join, run_id=args.run_id)
    if args.job == "shipment-points":
        jobs.rebuild_shipment_points(src["tvst"], args.target, args.run_ts,
                                     args.table)
        return None
    if args.job == "key-check":
        roots = dict(r.split("=", 1) for r in args.root)
        paths = {}
        for name, _, path in (t.partition("=") for t in args.tables):
            if not path and args.environment not in roots:
                raise SystemExit(f"no --root for environment {args.environment!r}, needed for table {name!r}")
            paths[name] = path or f"{roots[args.environment].rstrip('/')}/{name}"
        if args.state:
            return jobs.run_stored_key_checks(spark, paths, args.state, args.environment, report_path=args.report,
                                              run_date=args.date, run_id=args.run_id)
        frames = {name: read_current(spark, path) for name, path in paths.items()}
        config = [{name: [K.RULE_DUPLICATE_CHECK]} for name in frames]
        return jobs.run_key_checks(config, quality.registry_resolver(frames), args.environment, args.report,
                                   args.date, args.run_id)
    return jobs.run_file_checks(spark, args.folder, args.report, args.date, args.run_id)


def main() -> None:
    out = run(sys.argv[1:])
    if isinstance(out, DataFrame):
        out.show(REPORT_ROWS, truncate=False)
    elif out is not None:
        print(f"{out} rows appended")


if __name__ == "__main__":
    main()
