"""Physical-plan shape of the registered queries on the smallest tables."""

import re

import __spark_entry__ as entry
from conftest import SF_SMALL, plan_text


def _plan(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    return plan_text(df)


def test_star_detail_broadcasts_every_dimension_and_prunes_the_fact(spark):
    plan = _plan(spark, "star_detail")
    assert plan.count("BroadcastHashJoin") == 5
    assert "SortMergeJoin" not in plan
    fact_scan = [l for l in plan.splitlines() if "lineitem.parquet" in l][0]
    assert "l_extendedprice" not in fact_scan and "l_discount" not in fact_scan


def _operators(plan):
    return [re.match(r"[\s:+-]*(\w+)", line).group(1) for line in plan.splitlines() if line.strip()]


def test_sql_and_dataframe_star_join_plan_alike(spark):
    assert _operators(_plan(spark, "star_detail")) == _operators(_plan(spark, "star_detail_sql"))


def test_natural_key_is_partial_then_final_aggregate(spark):
    plan = _plan(spark, "natural_key_dups")
    assert "partial_count" in plan and plan.count("Exchange") == 1


def test_gaps_shuffle_the_fact_once_by_entity_and_bucket(spark):
    plan = _plan(spark, "appointment_gaps")
    windows = [line for line in plan.splitlines() if "hashpartitioning(o_custkey" in line and "bucket" in line]
    assert len(windows) >= 1
    # The one exchange on the entity alone carries counts, not rows.
    for k, line in enumerate(lines := plan.splitlines()):
        if "hashpartitioning(o_custkey" in line and "bucket" not in line:
            assert "HashAggregate" in lines[k + 1] or "Aggregate" in lines[k + 1] or "Window" in lines[k - 1]


def test_the_pivot_needs_no_sorted_aggregate(spark):
    assert "SortAggregate" not in _plan(spark, "months_wide_to_long")


def test_the_report_scans_the_fact_twice(spark):
    plan = _plan(spark, "quality_report")
    assert sum("lineitem.parquet" in line for line in plan.splitlines()) == 2


LAZY = {"months_wide_to_long", "months_unpivot_literal", "months_odd_headers", "diagnosis_fact",
        "diagnosis_rejects", "broadcast_nation"}  # a year range, or the size check of a broadcast


def test_building_a_query_starts_no_job(spark):
    from clinilake.plans import catalog
    sc = spark.sparkContext
    for name, query in catalog.QUERIES.items():
        if name in catalog.LOADS:
            continue
        sc.setJobGroup(f"build-{name}", name)
        query(spark, SF_SMALL)
        jobs = sc.statusTracker().getJobIdsForGroup(f"build-{name}")
        # Reading a schema from a footer is a job for each table.
        tables = 6 if name not in LAZY else 8
        started = [j for j in jobs if _rows_job(sc, j)]
        assert len(started) <= (2 if name in LAZY else 0), (name, started, tables)
    sc.setLocalProperty("spark.jobGroup.id", None)


def _rows_job(sc, job):
    """Whether a job is more than the one-task read of a footer."""
    info = sc.statusTracker().getJobInfo(job)
    stages = [sc.statusTracker().getStageInfo(s) for s in info.stageIds] if info else []
    return any(s is not None and not s.name.startswith("parquet at") for s in stages)


def test_mean_gap_has_no_window(spark):
    plan = _plan(spark, "mean_gap")
    assert "Window" not in plan and "Sort " not in plan


def test_orphans_reads_only_keys_of_the_dimension(spark):
    plan = _plan(spark, "orphans")
    labels_scan = [l for l in plan.splitlines() if "labels.parquet" in l][0]
    assert "ReadSchema: struct<doc_id:bigint>" in labels_scan
    docs_scan = [l for l in plan.splitlines() if "documents.parquet" in l][0]
    assert "text" not in docs_scan.split("ReadSchema")[1]


def test_unpivot_adds_no_exchange_after_the_pivot(spark):
    plan = _plan(spark, "months_wide_to_long")
    assert plan.count("Exchange") == 1 and "Expand" in plan
