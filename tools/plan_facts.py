"""Print the physical-plan facts that matter for scale, per catalogue query.

Usage: python tools/plan_facts.py [sf_dir] [name ...]  (set PLAN_FACTS_OUT to write a file)
For each query: exchanges, join strategies, partial/final aggregates and
window limits, and the pushed filters / read schema of each parquet scan.
The plan is the initial adaptive plan (before runtime re-optimisation).
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from martline.plans import catalog  # noqa: E402
from martline.session import get_spark  # noqa: E402

DEFAULT = ("latest_version_prefilter_secondary_order", "route_lead_time", "star_enrich", "day_cells",
           "variability_mart", "new_or_changed_rows", "dq_report", "file_dup_check")


def facts(plan: str) -> list[str]:
    out = []
    count = lambda pat: len(re.findall(pat, plan))
    out.append(f"exchanges={count(r'Exchange hashpartitioning')} "
               f"broadcast_exchanges={count(r'BroadcastExchange')} "
               f"sort_merge_joins={count(r'SortMergeJoin')} broadcast_hash_joins={count(r'BroadcastHashJoin')}")
    out.append(f"partial_aggregates={count(r'HashAggregate\(keys=[^)]*, functions=\[partial_')} "
               f"window_group_limits_partial={count(r'WindowGroupLimit[^\n]*Partial')} "
               f"windows={count(r'\bWindow \[')}")
    for m in re.finditer(r"FileScan parquet [^\n]*", plan):
        line = m.group(0)
        rs = re.search(r"ReadSchema: (struct<[^>]*>)", line)
        pf = re.search(r"PushedFilters: (\[[^\]]*\])", line)
        name = re.search(r"/([^/\]]+\.parquet)\]", line)
        read = f" read={rs.group(1)}" if rs else ""
        out.append(f"scan {name.group(1) if name else '(checkpointed table)'}: "
                   f"pushed={pf.group(1) if pf else '[]'}{read}")
    return out


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or list(DEFAULT)
    spark = get_spark("local[8]", shuffle_partitions=16, extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="martline-ckpt-")})
    qs = catalog.queries()
    lines: list[str] = []
    for name in names:
        df = qs[name](spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines.append(f"### {name}")
        seen = set()
        for f in facts(plan):
            if f not in seen:
                seen.add(f)
                lines.append("- " + re.sub(r"#\d+L?", "", f))
        lines.append("")
    text = "\n".join(lines)
    out = os.environ.get("PLAN_FACTS_OUT")
    if out:
        with open(out, "w") as fh:
            fh.write(text + "\n")
    else:
        print(text)


if __name__ == "__main__":
    main()
