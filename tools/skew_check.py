"""Hot-key experiment: one patient holds a third of all appointments.

Compares ``lag`` over ``Window.partitionBy(patient)`` with
:func:`clinilake.operators.gold.appointment_gaps` (lag by buckets) on
the same generated rows: wall time, and the longest task against the median
task of each job, read from Spark's event log in a scratch folder.

Usage: python tools/skew_check.py [rows] [cpus]
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def task_times(log_dir: str, job_groups: dict[str, str]) -> dict[str, tuple[float, float, int]]:
    """Per job group, the stage whose longest task is longest: (max task s,
    median task s of that stage, its task count), from the event log."""
    stage_group, durations = {}, {}
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    info = ev["Task Info"]
                    durations.setdefault(ev["Stage ID"], []).append(
                        (info["Finish Time"] - info["Launch Time"]) / 1000)
    out = {}
    for label, group in job_groups.items():
        stages = [lst for sid, lst in durations.items() if stage_group.get(sid) == group]
        worst = max(stages, key=max, default=[0.0])
        out[label] = (max(worst), statistics.median(worst), len(worst))
    return out


def main() -> None:
    from pyspark.sql import SparkSession, Window
    from pyspark.sql import functions as F

    from clinilake.operators import gold, synth

    rows = int(sys.argv[1]) if len(sys.argv) > 1 else 6_000_000
    cpus = sys.argv[2] if len(sys.argv) > 2 else "8"
    scratch = tempfile.mkdtemp(prefix="skew-")
    logs = os.path.join(scratch, "events")
    os.makedirs(logs)
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("skew-check")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", logs)
             .config("spark.eventLog.compress", "false")
             .config("spark.sql.shuffle.partitions", str(int(cpus) * 4))
             .config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from clinilake import session
    session.checkpoint_dir(spark, os.path.join(scratch, "checkpoints"))

    # A third of the appointments belong to patient 1; written once so both
    # runs read the same parquet.
    att = synth.attentions(spark, rows, 100_000, seed=1)
    hot = F.when(F.pmod(F.xxhash64("ATTID", F.lit("hot")), F.lit(3)) == 0, F.lit(1)).otherwise(F.col("PACID"))
    path = os.path.join(scratch, "fact_attention")
    att.withColumn("PACID", hot).write.parquet(path)
    fact = spark.read.parquet(path)

    def run(group: str, df) -> float:
        spark.sparkContext.setJobGroup(group, group)
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    w = Window.partitionBy("PACID").orderBy("ATTFIN01", "ATTID")
    naive = fact.select("PACID", "ATTID", "ATTFIN01", F.lag("ATTID").over(w).alias("prev_ATTID")) \
                .where(F.col("prev_ATTID").isNotNull())
    wall = {"window_by_patient": run("naive", naive)}
    wall["range_partitioned"] = run("ours", gold.appointment_gaps(fact, "PACID", "ATTFIN01", "ATTID"))
    spark.sparkContext.setJobGroup("counts", "counts")
    n_naive = naive.count()
    n_ours = gold.appointment_gaps(fact, "PACID", "ATTFIN01", "ATTID").count()
    spark.stop()
    tasks = task_times(logs, {"window_by_patient": "naive", "range_partitioned": "ours"})
    print(json.dumps({"rows": rows, "same_row_count": n_naive == n_ours,
                      "wall_sec": {k: round(v, 2) for k, v in wall.items()},
                      "max_task_sec": {k: round(v[0], 2) for k, v in tasks.items()},
                      "median_task_sec_same_stage": {k: round(v[1], 3) for k, v in tasks.items()},
                      "tasks_in_stage": {k: v[2] for k, v in tasks.items()},
                      "scratch": scratch}))


if __name__ == "__main__":
    main()
