"""States of batches, patched gaps, stable keys and partition upserts."""

import os
import random

import pytest
from pyspark.sql import functions as F

from clinilake import sinks
from clinilake.operators import gold, increment, normalize

from conftest import plan_text, rows


def _appointments(spark, n=800, seed=5):
    rnd = random.Random(seed)
    data = [(rnd.choice([None, "p0", "p0", *[f"p{i}" for i in range(40)]]), rnd.choice([None, *range(60)]), i)
            for i in range(n)]
    return spark.createDataFrame(data, "who string, day int, id int").select(
        "who", F.date_add(F.lit("2024-01-01").cast("date"), "day").cast("timestamp").alias("at"), "id")


def _cut(df, parts=3):
    return [df.where(F.pmod(F.xxhash64("id"), F.lit(parts)) == i) for i in range(parts)]


def test_merged_states_equal_the_whole(spark):
    df = _appointments(spark)
    a, b, c = _cut(df)
    state = increment.merge_gap_states(increment.merge_gap_states(
        increment.gap_state(c, "who", "at"), increment.gap_state(a, "who", "at")), increment.gap_state(b, "who", "at"))
    assert rows(increment.mean_gap_of(state)) == rows(gold.mean_gap(df, "who", "at"))
    months = increment.merge_counts(increment.month_state(a.unionByName(b), "who", "at"),
                                    increment.month_state(c, "who", "at"), "diagnoses")
    assert rows(months) == rows(gold.diagnosis_by_month(df, "who", "at"))
    counts = increment.merge_counts(increment.count_state(a, ["who"]), increment.count_state(b.unionByName(c), ["who"]))
    assert rows(counts) == rows(gold.attention_counts(df, ["who"]))
    empty = increment.gap_state(df.limit(0), "who", "at")
    assert rows(increment.merge_gap_states(empty, state)) == rows(state)


@pytest.mark.parametrize("hot_rows", [4, 10**6])
def test_patched_gaps_equal_the_union(spark, hot_rows):
    df = _appointments(spark)
    a, b, c = _cut(df)
    linked = increment.links(a, "who", "at", "id", hot_rows)
    for batch in (b, c, c, a.limit(20), df.limit(0)):
        patch = increment.patched_links(linked, batch, hot_rows)
        linked = spark.createDataFrame(increment.apply_links(linked, patch).collect(), linked.schema)
    assert rows(increment.gaps_of(linked)) == rows(gold.appointment_gaps(df, "who", "at", "id"))


def test_a_batch_patches_its_own_gaps_only(spark):
    at = "timestamp '2024-01-01' + make_interval(0, 0, 0, day)"
    old = spark.createDataFrame([(k, d, f"{k}{d}") for k in "abc" for d in (0, 10, 20, 30)], "who string, day int, id string")
    linked = increment.links(old.selectExpr("who", f"{at} as at", "id"), "who", "at", "id")
    late = spark.createDataFrame([("b", 14, "b14"), ("b", 12, "b12"), ("d", 3, "d3"), ("c", 10, "c10")],
                                 "who string, day int, id string").selectExpr("who", f"{at} as at", "id")
    patch = increment.patched_links(linked, late)
    assert sorted((r.id, r.prev_id, r.linked) for r in patch.collect()) == [
        ("b12", "b10", True), ("b14", "b12", True), ("b20", "b14", True), ("d3", None, False)]


def test_links_partitioned_by_entity_are_read_for_its_entities_only(spark, scratch):
    df = _appointments(spark).where("who is not null")
    increment.links(df, "who", "at", "id").write.partitionBy("who").parquet(f"{scratch}/links")
    linked = spark.read.parquet(f"{scratch}/links").select("who", "at", "id", "prev_at", "prev_id", "linked")
    patch = increment.patched_links(linked, df.where("who = 'p7'").withColumn("id", F.col("id") + 10_000))
    assert patch.where("who <> 'p7'").count() == 0 and patch.count() > 0


def test_new_codes_are_numbered_on(spark):
    first = spark.createDataFrame([("m",), ("c",), (None,), ("m",)], "code string")
    dim, fact = normalize.extract_dimension(first, "code", "ID")
    assert rows(dim) == [(1, "c"), (2, "m")]
    later = spark.createDataFrame([("a",), ("m",), ("z",), (None,), ("a",)], "code string")
    whole, fact = normalize.extend_dimension(later, "code", dim, "ID")
    assert rows(whole) == [(1, "c"), (2, "m"), (3, "a"), (4, "z")]
    assert sorted(r.ID or 0 for r in fact.collect()) == [0, 2, 3, 3, 4]
    assert normalize.new_codes(later, "code", whole, "ID").count() == 0
    assert rows(normalize.new_codes(later, "code", dim.limit(0), "ID")) == [(1, "a"), (2, "m"), (3, "z")]
    assert normalize.new_codes(later.limit(0), "code", dim, "ID").count() == 0
    clash = later.select(F.col("code").alias("known"), F.lit("x").alias("ID"))
    assert normalize.new_codes(clash, "known", dim, "ID", "code").count() == 2


def _files(path):
    return {(os.path.relpath(os.path.join(d, f), path), os.stat(os.path.join(d, f)).st_mtime_ns)
            for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_upsert_touches_its_partitions_only_and_may_be_repeated(spark, scratch):
    path = f"{scratch}/t"
    base = spark.range(300).select("id", (F.col("id") % 6).cast("int").alias("part"), F.lit("old").alias("v"))
    sinks.upsert_partitions(base, path, ["id", "part"], ["part"])
    before = _files(path)
    batch = spark.createDataFrame([(1, 1, "new", 1), (1, 1, "newer", 2), (1001, 1, "added", 1), (2000, 9, "part", 1)],
                                  "id long, part int, v string, seq int")
    for _ in range(2):
        sinks.upsert_partitions(
            batch.groupBy("id", "part").agg(F.max_by("v", "seq").alias("v")), path, ["id", "part"], ["part"])
        want = {(r.id, r.part): r.v for r in base.collect()} | {(1, 1): "newer", (1001, 1): "added", (2000, 9): "part"}
        got = spark.read.parquet(path).collect()
        assert {(r.id, r.part): r.v for r in got} == want and len(got) == len(want)
        untouched = {f for f in before if not f[0].startswith("part=1/")}
        assert untouched <= _files(path)
    with pytest.raises(ValueError, match="partition columns"):
        sinks.upsert_partitions(base, path, ["id"], ["part"])
    with pytest.raises(Exception, match="part is null"):
        sinks.upsert_partitions(base.withColumn("part", F.lit(None).cast("int")), path, ["id", "part"], ["part"])
    assert spark.read.parquet(path).count() == 302


def test_upsert_keeps_the_newest_row_of_a_key(spark, scratch):
    path = f"{scratch}/t"
    batch = spark.createDataFrame([(1, "a", 5, "late"), (1, "a", 9, "last"), (2, "a", 1, "only"), (None, "b", 1, "x")],
                                  "id long, part string, seq int, v string")
    for _ in range(2):
        sinks.upsert_partitions(batch, path, ["id", "part"], ["part"], newest=["seq"])
    got = sorted((r.id or 0, r.part, r.v) for r in spark.read.parquet(path).collect())
    assert got == [(0, "b", "x"), (1, "a", "last"), (2, "a", "only")]


def test_upsert_prunes_partitions_at_run_time(spark, scratch):
    path = f"{scratch}/t"
    spark.range(100).withColumn("part", F.col("id") % 10).write.partitionBy("part").parquet(path)
    touched = spark.createDataFrame([(3,)], "part long")
    plan = plan_text(spark.read.parquet(path).join(touched.where("part > 0").distinct(), ["part"], "left_semi"))
    assert "dynamicpruning" in plan
