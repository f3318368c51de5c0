"""Benchmark the headline queries.

Runs each query of ``HEADLINE`` on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]``, executing the full plan
into Spark's ``noop`` sink (nothing is collected to the driver). One warm-up
pass, then ``$BENCH_RUNS`` timed passes (default 3); the median per query is
reported. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from martline.plans import catalog  # noqa: E402
from martline.session import get_spark  # noqa: E402

HEADLINE = (
    "shipment_mart_changes",  # E1: incremental shipment mart
    "variability_mart",  # E2: wide 24-metric mart
    "variability_changes",  # E2 incl. change detection
    "dimension_rebuild",  # E3
    "dq_report",  # E4
    "file_dup_check",  # E5
    "latest_version_tombstone",
    "star_enrich",
    "day_cells",
    "ptm_weighted_total_week",
    "new_or_changed_rows",
    "route_lead_time",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or list(HEADLINE)
    spark = get_spark(f"local[{cpus}]", app="martline-bench", shuffle_partitions=int(cpus) * 2,
                      extra={"spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false",
                             "spark.checkpoint.dir": tempfile.mkdtemp(prefix="martline-ckpt-")})
    qs = catalog.queries()
    times: dict[str, float | None] = {}
    errors: dict[str, str] = {}
    for name in names:
        fn = qs[name]
        try:
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
            samples = []
            for _ in range(runs):
                t0 = time.perf_counter()
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                samples.append(time.perf_counter() - t0)
            times[name] = round(statistics.median(samples), 3)
        except Exception as e:  # noqa: BLE001 - report and go on with the other queries
            times[name] = None
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_queries_total",
        "value": round(sum(v for v in times.values() if v is not None), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
