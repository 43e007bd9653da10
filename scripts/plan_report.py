"""Write PLANS.md: the physical-plan shape of every registered query.

usage: python scripts/plan_report.py [sf_dir]   (default /root/testdata/sf0.01)

For each query: the physical operators (with counts) of the executed plan
(AQE initial plan), and for every Parquet scan the columns read, the pushed
filters and the partition filters. This is the review list for scale
problems: single-partition exchanges on growing inputs, sort-based
aggregates, nested-loop joins between growing sides, Python UDFs, scans
reading unneeded columns.
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NODE = re.compile(r"^[\s:+\-|]*([A-Z][A-Za-z]+(?:Exec)?)[\s\[(]")


def summarize(plan: str):
    ops, scans = Counter(), []
    for line in plan.split("\n"):
        m = NODE.match(line)
        if m:
            ops[m.group(1)] += 1
        if "FileScan" in line:
            cols = re.search(r"FileScan \w+ \[([^\]]*)\]", line)
            # long filter lists are cut by Spark with "..."
            pushed = re.search(r"PushedFilters: \[(.*?)(?:\]|\.\.\.)", line)
            part = re.search(r"PartitionFilters: \[(.*?)(?:\], |\.\.\.)", line)
            scans.append((cols.group(1) if cols else "", pushed.group(1) if pushed else "",
                          part.group(1) if part else ""))
    return ops, scans


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from martstar import registry
    from martstar.session import get_session

    spark = get_session("local[8]", 8)
    out = ["# Physical plans of the registered queries", "",
           f"Generated by `scripts/plan_report.py` at {os.path.basename(sf_dir)} (warehouse mode).", ""]
    for key, fn in registry.QUERIES.items():
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        ops, scans = summarize(plan)
        out.append(f"## {key}")
        out.append("operators: " + ", ".join(f"{k}×{v}" if v > 1 else k for k, v in sorted(ops.items())))
        for cols, pushed, part in scans:
            cols = re.sub(r"#\d+L?", "", cols)
            pushed = re.sub(r"#\d+L?", "", pushed)
            part = re.sub(r"#\d+L?", "", part)
            out.append(f"- scan [{cols}]" + (f" pushed [{pushed}]" if pushed else "")
                       + (f" partitions [{part}]" if part else ""))
        out.append("")
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main()
