"""The natural key, batch by batch, against the whole table."""

import datetime as dt
import os

from pyspark.sql import functions as F

from clinilake.operators import ledger, quality

from conftest import plan_text, rows

KEYS = ["doc", "day"]


def _batches(spark):
    day = dt.date(2024, 1, 1)
    first = [("a", day, 1), ("b", day, 2), ("b", day, 3), (None, day, 4), (None, None, 5), ("1:x", None, 6)]
    second = [("a", day, 7), ("c", day, 8), (None, None, 9), ("d", None, 10), ("d", None, 11), ("-", day, 12), ("1", None, 13)]
    return [spark.createDataFrame(r, "doc string, day date, id int") for r in (first, second)]


def test_two_batches_equal_the_whole_table(spark, scratch):
    path = f"{scratch}/ledger"
    first, second = _batches(spark)
    ledger.load(first, path, KEYS, "one", buckets=4)
    assert rows(ledger.duplicates(first, path, KEYS, 4)) == rows(quality.duplicate_keys(first, KEYS))
    for _ in range(2):  # a batch sent again counts once
        ledger.load(second, path, KEYS, "two", buckets=4)
        whole = first.unionByName(second)
        assert rows(ledger.verdict(ledger.read(spark, path), KEYS, "t")) == rows(quality.key_verdict(whole, KEYS, "t"))
        want = quality.duplicate_keys(whole, KEYS)
        mine = [r for r in rows(want) if r[:2] in {tuple(x) for x in second.select(*KEYS).collect()}]
        assert rows(ledger.duplicates(second, path, KEYS, 4)) == mine


def test_a_batch_rewrites_its_own_buckets_only(spark, scratch):
    path = f"{scratch}/ledger"
    ledger.load(spark.range(400), path, ["id"], "one", buckets=16)

    def files():
        return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
                for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}
    before = files()
    ledger.load(spark.range(1000, 1001), path, ["id"], "two", buckets=16)
    after = files()
    assert sum(after.get(f) != t for f, t in before.items()) <= 1
    assert ledger.verdict(ledger.read(spark, path), ["id"], "t").first()["is_unique"]


def test_prints_tell_values_apart_and_odd_columns(spark, scratch):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), ("", None), (None, ""), ("1:a", "")], "`x.y` string, print string")
    assert df.select(ledger.print_of(["x.y", "print"], dict(df.dtypes))).distinct().count() == 5
    path = f"{scratch}/l"
    assert ledger.read(spark, path).count() == 0
    ledger.load(df, path, ["x.y", "print"], "b")
    assert ledger.duplicates(df, path, ["x.y", "print"]).count() == 0
    ledger.load(df.limit(0), path, ["x.y", "print"], "empty")
    assert ledger.read(spark, path).agg(F.sum("n")).first()[0] == 5


def test_a_smaller_resend_keeps_the_other_entries_and_other_batches(spark, scratch):
    path = f"{scratch}/l"

    def load(ids, batch):
        ledger.load(spark.createDataFrame([(i,) for i in ids], "id long"), path, ["id"], batch, buckets=2)

    def counts():
        prints = {r.p: r.id for r in spark.range(9).select("id", ledger.print_of(["id"], {"id": "bigint"}).alias("p")).collect()}
        return sorted((prints[r.print], r.batch, r.n) for r in ledger.read(spark, path).collect())
    load([1, 1, 2, 3], "one")
    load([1, 4], "two")
    load([1, 2, 2], "one")
    assert counts() == [(1, "one", 1), (1, "two", 1), (2, "one", 2), (3, "one", 1), (4, "two", 1)]


def _written_plan(monkeypatch, load):
    plans = []
    monkeypatch.setattr(ledger.sinks, "replace_partitions", lambda df, *_: plans.append(plan_text(df)))
    load()
    return plans[0]


def test_a_load_hashes_its_keys_once_and_deals_nothing_by_bucket(spark, scratch, monkeypatch):
    """Keys were grouped twice (the second time sorted), joined again with themselves, and
    stored rows dealt by bucket, with a task for each, wherever tables were large."""
    path = f"{scratch}/l"
    df = spark.range(100)
    ledger.load(df, path, ["id"], "one", buckets=2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _written_plan(monkeypatch, lambda: ledger.load(df, path, ["id"], "one", buckets=2))
        found = plan_text(ledger.duplicates(df, path, ["id"], 2))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortAggregate" not in plan and "SortMergeJoin" not in plan
    assert found.count("SortMergeJoin") == 1 and "BroadcastHashJoin" in found
