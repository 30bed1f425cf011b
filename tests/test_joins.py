import pytest
from pyspark.sql import functions as F

from clinilake.operators import synth
from clinilake.operators.joins import Dim, fits_broadcast, star_join
from clinilake.plans import jobs
from clinilake.sources import literal_table

from conftest import plan_text, rows


def _tables(spark):
    fact = spark.createDataFrame(
        [(1, 10, 100), (2, 10, 200), (3, 99, 100), (4, None, 100), (5, 20, 300)],
        "id int, a int, b int")
    da = spark.createDataFrame([(10, "x"), (20, "y"), (20, "y2"), (30, "unused")], "a int, an string")
    db = spark.createDataFrame([(100, 1), (200, 2), (300, 9)], "b int, g int")
    dg = spark.createDataFrame([(1, "g1"), (2, "g2")], "g int, gn string")
    return fact, da, db, dg


def test_inner_star_drops_unmatched_and_null_keys_and_fans_out(spark):
    fact, da, db, dg = _tables(spark)
    dims = [Dim(da, "a", [("a", "a")]), Dim(db, "b", [("b", "b")]),
            Dim(dg, "g", [("g", "g")], parent="b")]
    out = star_join(fact, dims, ["f.id", "a.an", "g.gn"])
    # id 3: unmatched a; id 4: null a; id 5: b=300 has g=9 with no group row.
    assert rows(out) == [(1, "x", "g1"), (2, "x", "g2")]


def test_left_dimension_keeps_rows(spark):
    fact, da, db, dg = _tables(spark)
    out = star_join(fact, [Dim(da, "a", [("a", "a")], how="left")], ["f.id", "a.an"])
    assert rows(out) == [(1, "x"), (2, "x"), (3, None), (4, None), (5, "y"), (5, "y2")]


def test_prejoin_same_rows(spark):
    fact, da, db, dg = _tables(spark)
    base = [Dim(db, "b", [("b", "b")])]
    seq = star_join(fact, base + [Dim(dg, "g", [("g", "g")], parent="b")], ["f.id", "g.gn"])
    pre = star_join(fact, [Dim(db, "b", [("b", "b")]),
                           Dim(dg, "g", [("g", "g")], parent="b", prejoin=True)], ["f.id", "g.gn"])
    assert rows(seq) == rows(pre)


def test_role_playing_dimension(spark):
    fact = spark.createDataFrame([(1, 10, 20)], "id int, from_a int, to_a int")
    da = spark.createDataFrame([(10, "x"), (20, "y")], "a int, an string")
    out = star_join(fact, [Dim(da, "src", [("from_a", "a")]), Dim(da, "dst", [("to_a", "a")])],
                    ["f.id", F.col("src.an").alias("src"), F.col("dst.an").alias("dst")])
    assert rows(out) == [(1, "x", "y")]


def test_parent_order_and_alias_checks(spark):
    fact, da, db, dg = _tables(spark)
    with pytest.raises(ValueError):
        star_join(fact, [Dim(dg, "g", [("g", "g")], parent="b"), Dim(db, "b", [("b", "b")])])
    with pytest.raises(ValueError):
        star_join(fact, [Dim(da, "f", [("a", "a")])])


def test_fits_broadcast_bounds(spark):
    small = literal_table(spark, [(1, "abc"), (2, "de")], "k int, v string")
    assert fits_broadcast(small, max_rows=2, max_bytes=100)
    assert not fits_broadcast(small, max_rows=1)
    assert not fits_broadcast(small, max_rows=10, max_bytes=10)
    assert not fits_broadcast(spark.range(100), max_rows=50)


def test_checked_broadcast_plan(spark):
    fact = spark.range(1000).select(F.col("id"), (F.col("id") % 3).cast("int").alias("k"))
    dim = literal_table(spark, [(0, "a"), (1, "b"), (2, "c")], "k int, v string")
    out = star_join(fact, [Dim(dim, "d", [("k", "k")], broadcast=True)], ["f.id", "d.v"])
    assert "BroadcastHashJoin" in plan_text(out)
    assert out.count() == 1000


def test_oversized_broadcast_falls_back(spark):
    fact = spark.range(100).withColumnRenamed("id", "k")
    dim = spark.range(100).withColumnRenamed("id", "k")
    out = star_join(fact, [Dim(dim, "d", [("k", "k")], broadcast=True, max_rows=10)], ["f.k"])
    assert out.count() == 100


def test_health_detail_sql_and_df_agree(spark):
    silver = synth.silver(spark, 50, 300, 10, seed=3)
    a = jobs.detail(spark, silver, "sql")
    b = jobs.detail(spark, silver, "df")
    assert a.columns == b.columns and len(a.columns) == 13
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.count() == 300  # generated keys always match


def test_detail_broadcasts_every_catalogue(spark):
    silver = synth.silver(spark, 50, 300, 10, seed=3)
    plan = plan_text(jobs.detail_df(silver))
    assert plan.count("BroadcastHashJoin") >= 4


def test_validate_rejects_repeated_dimension_keys(spark):
    fact, da, db, dg = _tables(spark)
    with pytest.raises(ValueError, match="dimension a"):
        star_join(fact, [Dim(da, "a", [("a", "a")])], validate=True)
    assert star_join(fact, [Dim(db, "b", [("b", "b")])], ["f.id"], validate=True).count() == 5


def test_jobs_cli_runs_a_job(spark, scratch):
    jobs.main(["build_silver", "--root", scratch, "--patients", "5", "--attentions", "9"])
    jobs.main(["build_detail", "--root", scratch, "--mode", "df"])
    assert spark.read.parquet(f"{scratch}/dev/gold/atencion_detalle").count() == 9


def test_complete_unselected_dimension_is_skipped(spark):
    fact = spark.createDataFrame([(1, 10, 100), (2, 20, 100)], "id int, a int, b int")
    da = spark.createDataFrame([(10, "x"), (20, "y")], "a int, an string")
    db = spark.createDataFrame([(100, 1)], "b int, g int")
    dg = spark.createDataFrame([(1, "g1")], "g int, gn string")
    dims = [Dim(da, "a", [("a", "a")], complete=True), Dim(db, "b", [("b", "b")], complete=True),
            Dim(dg, "g", [("g", "g")], parent="b", complete=True)]
    only_fact = star_join(fact, dims, ["f.id"])
    assert "Join" not in plan_text(only_fact, "optimized")
    with_group = star_join(fact, dims, ["f.id", F.col("g.gn").alias("group")])
    plan = plan_text(with_group, "optimized")
    assert plan.count("Join") == 2  # b is kept because g hangs off it; a is skipped
    assert rows(with_group) == [(1, "g1"), (2, "g1")]
    # Without the assertion every dimension is joined.
    plain = [Dim(da, "a", [("a", "a")]), Dim(db, "b", [("b", "b")])]
    assert plan_text(star_join(fact, plain, ["f.id"]), "optimized").count("Join") == 2


def test_incomplete_child_keeps_its_complete_parent(spark):
    fact = spark.createDataFrame([(1, 100)], "id int, b int")
    db = spark.createDataFrame([(100, 1)], "b int, g int")
    dg = spark.createDataFrame([(2, "g2")], "g int, gn string")  # no group 1: inner join drops the row
    dims = [Dim(db, "b", [("b", "b")], complete=True), Dim(dg, "g", [("g", "g")], parent="b")]
    assert star_join(fact, dims, ["f.id"]).count() == 0


def test_fits_broadcast_counts_nested_values(spark):
    wide = spark.range(10).select(F.col("id"), F.array_repeat(F.lit("abcdefghij"), 100).alias("tags"))
    assert not fits_broadcast(wide, max_rows=100, max_bytes=5000)
    assert fits_broadcast(wide, max_rows=100, max_bytes=50000)


def test_star_join_matches_a_pandas_model(spark):
    import random

    import pandas as pd

    def model(fact, a, b, g, how_a, how_g):
        out = fact.merge(a, on="a", how=how_a)
        out = out.merge(b, on="b", how="inner")
        out = out.merge(g, on="g", how=how_g)
        return sorted(((int(r.id), None if pd.isna(r.an) else r.an, None if pd.isna(r.gn) else r.gn)
                       for r in out.itertuples()), key=repr)

    for seed in range(4):
        rnd = random.Random(seed)
        fact = pd.DataFrame({"id": range(60),
                             "a": [rnd.choice([1, 2, 3, 4, None]) for _ in range(60)],
                             "b": [rnd.choice([10, 20, 30]) for _ in range(60)]})
        a = pd.DataFrame({"a": [1, 2, 2, 5], "an": ["x", "y", "y2", "z"]})    # 2 repeats, 3/4 missing
        b = pd.DataFrame({"b": [10, 20, 30], "g": [100, 200, 300]})
        g = pd.DataFrame({"g": [100, 300], "gn": ["g1", "g3"]})                # 200 missing
        def plain(v):
            if pd.isna(v):
                return None
            return int(v) if isinstance(v, float) else v

        def sdf(p, ddl):
            return spark.createDataFrame([tuple(plain(v) for v in r) for r in p.itertuples(index=False)], ddl)
        for how_a in ("inner", "left"):
            for how_g in ("inner", "left"):
                out = star_join(sdf(fact, "id int, a int, b int"),
                                [Dim(sdf(a, "a int, an string"), "da", [("a", "a")], how=how_a),
                                 Dim(sdf(b, "b int, g int"), "db", [("b", "b")]),
                                 Dim(sdf(g, "g int, gn string"), "dg", [("g", "g")], parent="db", how=how_g)],
                                ["f.id", "da.an", "dg.gn"])
                expect = model(fact.astype({"a": "Int64"}), a, b, g, how_a, how_g)
                assert rows(out) == expect, (seed, how_a, how_g)


def test_dimension_below_a_prejoined_grandchild(spark):
    fact = spark.createDataFrame([(1, 10)], "id int, a int")
    a = spark.createDataFrame([(10, 20)], "a int, b int")
    b = spark.createDataFrame([(20, 30)], "b int, c int")
    c = spark.createDataFrame([(30, 40)], "c int, d int")
    d = spark.createDataFrame([(40, "end")], "d int, v string")
    dims = [Dim(a, "a", [("a", "a")]), Dim(b, "b", [("b", "b")], parent="a", prejoin=True),
            Dim(c, "c", [("c", "c")], parent="b", prejoin=True), Dim(d, "d", [("d", "d")], parent="c")]
    assert rows(star_join(fact, dims, ["f.id", "d.v"])) == [(1, "end")]
