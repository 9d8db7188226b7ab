"""Summarise the executed (post-AQE) physical plan of every registered job.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md

The plan shown is the DataFrame's own executed plan, so the job is run with
``collect()``; this is a development report, run it on a small scale factor.

Per job: shuffle exchanges (and their partitioning), broadcast exchanges,
scanned tables with the columns read and the filters pushed to Parquet,
window operators, and the operators that would leave whole-stage codegen
for Python (there should be none).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline.catalog import QUERIES  # noqa: E402
from ledgerline.session import build_session  # noqa: E402


def summarise(plan: str) -> dict:
    # an adaptive plan prints its final plan, then the initial one: keep the final
    plan = plan.split("== Initial Plan ==")[0]
    lines = plan.splitlines()
    shuffles = [re.sub(r",? ?\[plan_id=\d+\]", "", re.sub(r"#\d+L?", "", l.split("Exchange ", 1)[1])).strip()
                for l in lines if re.search(r"\bExchange (hashpartitioning|rangepartitioning|SinglePartition|"
                                            r"RoundRobin)", l)]
    broadcasts = sum(1 for l in lines if "BroadcastExchange" in l)
    reused = sum(1 for l in lines if "ReusedExchange" in l)
    scans = []
    for l in lines:
        m = re.search(r"FileScan (\w+) \[.*?Location: \w+\(\d+ paths?\)\[([^\]]+)\]", l)
        if m:
            path = m.group(2)
            table = ("scratch:" + m.group(1)) if "..." in path else \
                os.path.basename(path.rstrip("/")).replace(".parquet", "")
            pushed = re.search(r"PushedFilters: \[(.*?)\]", l)
            output = re.search(r"FileScan \w+ \[([^\]]*)\]", l)
            cols = [c for c in output.group(1).split(",") if c.strip()] if output else []
            scans.append((table, len(cols), (pushed.group(1) if pushed else "")[:80]))
        elif "Scan ExistingRDD" in l or "Scan LogicalRDD" in l:
            scans.append(("checkpoint", 0, ""))
    windows = [re.sub(r"#\d+L?", "", l.strip())[:90] for l in lines if re.search(r"\bWindow \[", l)]
    python = [l.strip() for l in lines if re.search(r"PythonUDF|BatchEvalPython|ArrowEvalPython|FlatMapGroupsIn", l)]
    return {"shuffles": shuffles, "broadcasts": broadcasts, "reused": reused, "scans": scans,
            "windows": windows, "python": python}


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    print(f"# Executed plans at `{sf_dir}` (local[8], AQE on)\n")
    print("Generated by `tools/plan_report.py`. Shuffle partitioning keys are shown without expression ids; "
          "'checkpoint' scans read the materialised range-numbered frame of a ranked job.\n")
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        print(f"## {name}\n")
        print(f"- shuffles: {len(s['shuffles'])}" + (f" ({'; '.join(sorted(set(s['shuffles'])))})"
                                                      if s["shuffles"] else ""))
        print(f"- broadcast exchanges: {s['broadcasts']}, reused exchanges: {s['reused']}")
        scans = ", ".join(f"{t}[{n} cols{'; pushed: ' + p if p else ''}]" for t, n, p in s["scans"])
        print(f"- scans: {scans}")
        if s["windows"]:
            print(f"- windows: {' | '.join(s['windows'])}")
        print(f"- python operators: {len(s['python'])}\n")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
