"""Hot-key star join: does AQE split the skewed fact partition?

Broadcast is switched off so every dimension is a sort-merge join (the 100 TB
case for large dimensions); a third of the appointments point at one patient.
Prints the join wall time and whether an adaptive plan update in the event
log (written to a scratch folder) marks a join as skew-split.  The skew
threshold is lowered to fit a laptop-sized run; Spark's defaults (256 MB,
5x the median) apply at scale.

Usage: python tools/skew_join_check.py [rows] [cpus]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from clinilake.operators import synth
    from clinilake.plans import jobs

    rows = int(sys.argv[1]) if len(sys.argv) > 1 else 6_000_000
    cpus = sys.argv[2] if len(sys.argv) > 2 else "8"
    scratch = tempfile.mkdtemp(prefix="skewjoin-")
    logs = os.path.join(scratch, "events")
    os.makedirs(logs)
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("skew-join-check")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", logs)
             .config("spark.eventLog.compress", "false")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.autoBroadcastJoinThreshold", "-1")
             .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
             .config("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "4MB")
             .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4MB")
             .config("spark.sql.shuffle.partitions", str(int(cpus) * 4))
             .config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    silver = synth.silver(spark, 200_000, rows, 10, seed=5)
    hot = F.when(F.pmod(F.xxhash64("ATTID", F.lit("hot")), F.lit(3)) == 0, F.lit(1)).otherwise(F.col("PACID"))
    for name in ("fact_attention", "dim_patient"):
        df = silver[name].withColumn("PACID", hot) if name == "fact_attention" else silver[name]
        df.write.parquet(os.path.join(scratch, name))
        silver[name] = spark.read.parquet(os.path.join(scratch, name))
    detail = jobs.detail_df(silver)
    t0 = time.perf_counter()
    detail.write.format("noop").mode("overwrite").save()
    wall = time.perf_counter() - t0
    n = detail.count()
    spark.stop()
    final = ""
    for path in glob.glob(os.path.join(logs, "**", "*"), recursive=True):
        if os.path.isfile(path):
            with open(path) as fh:
                for line in fh:
                    ev = json.loads(line)
                    if ev.get("Event", "").endswith("SparkListenerSQLAdaptiveExecutionUpdate"):
                        final = ev.get("physicalPlanDescription", "")
                        if "skew=true" in final:
                            break
    print(json.dumps({"rows": rows, "detail_rows": n, "wall_sec": round(wall, 2),
                      "sort_merge_join": "SortMergeJoin" in final,
                      "skew_split_join": "skew=true" in final, "scratch": scratch}))


if __name__ == "__main__":
    main()
