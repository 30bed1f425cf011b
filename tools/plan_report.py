"""Write PLANS.md: the physical-plan shape of every registered query.

For each query: shuffles by kind, join strategies, aggregates and windows,
and every parquet scan with the columns it reads and the filters pushed to
it.  Plans are the initial adaptive plans (AQE may still coalesce
partitions or switch a join to broadcast at run time).

Usage: python tools/plan_report.py [sf_dir] [out.md]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

OPERATORS = ["BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
             "HashAggregate", "SortAggregate", "ObjectHashAggregate", "Window", "Expand",
             "Generate", "MapInPandas", "InMemoryTableScan", "Scan ExistingRDD", "LocalTableScan"]


def summarise(plan: str) -> tuple[Counter, list[str]]:
    counts = Counter()
    for kind in re.findall(r"Exchange (\w+)", plan):
        counts[f"Exchange {kind}"] += 1
    for op in OPERATORS:
        n = len(re.findall(rf"\b{re.escape(op)}\b", plan))
        if n:
            counts[op] = n
    scans = []
    for line in plan.splitlines():
        if "FileScan parquet" not in line:
            continue
        table = re.search(r"/(\w+)\.parquet\]", line)
        pushed = re.search(r"PushedFilters: \[([^\]]*)\]", line)
        schema = re.search(r"ReadSchema: (struct<.*>)\s*$", line)
        scans.append(f"`{table.group(1) if table else '?'}` reads "
                     f"`{schema.group(1) if schema else '?'}`"
                     + (f", pushed `{pushed.group(1)}`" if pushed and pushed.group(1) else ""))
    return counts, scans


def physical_plan(df) -> str:
    """The physical section of ``df.explain("extended")``."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("extended")
    return buf.getvalue().split("== Physical Plan ==", 1)[1]


def main() -> None:
    from pyspark.sql import SparkSession

    from clinilake.plans import catalog

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out = sys.argv[2] if len(sys.argv) > 2 else os.path.join(
        os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.maxMetadataStringLength", "2000").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    lines = ["# Physical plans of the registered queries", "",
             f"Generated by `tools/plan_report.py` on `{os.path.basename(sf_dir.rstrip('/'))}` "
             "with Spark defaults (10 MB broadcast threshold, AQE on). Initial adaptive plans: "
             "AQE can still coalesce partitions or turn a sort-merge join into a broadcast at run "
             "time.", ""]
    for name, fn in catalog.QUERIES.items():
        plan = physical_plan(fn(spark, sf_dir))
        counts, scans = summarise(plan)
        shape = ", ".join(f"{k} x{v}" for k, v in sorted(counts.items())) or "narrow"
        lines += [f"## {name}", "", f"- operators: {shape}"]
        lines += [f"- scan: {s}" for s in scans]
        lines.append("")
    spark.stop()
    with open(out, "w") as fh:
        fh.write("\n".join(lines))
    print(out)


if __name__ == "__main__":
    main()
