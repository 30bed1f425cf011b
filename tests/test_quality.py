import datetime as dt

from pyspark.sql import functions as F

from clinilake.operators import quality

from conftest import plan_text, rows

T1, T2 = dt.datetime(2024, 1, 1, 8), dt.datetime(2024, 1, 1, 9)


def _view(spark):
    return spark.createDataFrame(
        [("1", T1), ("1", T1), ("2", T1), ("2", T1), ("2", T1), ("3", T1), ("3", T2),
         (None, T1), (None, T1)], "PACDOC string, FECHA_ATENCION timestamp")


def test_duplicate_keys_pairs_triples_and_nulls(spark):
    out = quality.duplicate_keys(_view(spark), ["PACDOC", "FECHA_ATENCION"])
    assert out.columns == ["PACDOC", "FECHA_ATENCION", "conteo"]
    assert rows(out) == [("1", T1, 2), ("2", T1, 3), (None, T1, 2)]


def test_is_unique_and_verdict(spark):
    v = _view(spark)
    assert not quality.is_unique(v, ["PACDOC", "FECHA_ATENCION"])
    assert quality.is_unique(v.dropDuplicates(), ["PACDOC", "FECHA_ATENCION"])
    verdict = quality.key_verdict(v, ["PACDOC", "FECHA_ATENCION"], "atencion_detalle").first()
    assert (verdict["dup_groups"], verdict["dup_rows"], verdict["is_unique"]) == (3, 4, False)
    ok = quality.key_verdict(v.dropDuplicates(), ["PACDOC", "FECHA_ATENCION"], "x").first()
    assert (ok["dup_groups"], ok["dup_rows"], ok["is_unique"]) == (0, 0, True)


def test_orphans_include_null_keys(spark):
    fact = spark.createDataFrame([(1, 10), (2, 11), (3, None)], "id int, fk int")
    dim = spark.createDataFrame([(10,)], "pk int")
    assert rows(quality.orphans(fact, dim, "fk", "pk"), "id") == [(2,), (3,)]


def test_domain_and_length(spark):
    df = spark.createDataFrame([("SI", "abc"), ("NO", "abcdef"), ("Sí", None), (None, "x")],
                               "a string, b string")
    assert rows(quality.outside_domain(df, "a", ["SI", "NO"]), "a") == [("Sí",)]
    assert rows(quality.too_long(df, "b", 3), "b") == [("abcdef",)]


def test_summary_and_report(spark):
    df = spark.createDataFrame([(1, "SI", "abc"), (None, "XX", "abcdef"), (3, None, None)],
                               "k int, a string, b string")
    s = quality.summary(df, "t", not_null=["k", "a"], max_length={"b": 3}, domains={"a": ["SI", "NO"]})
    assert s.columns == ["check_name", "table_name", "column_name", "violations"]
    assert rows(s) == [("domain", "t", "a", 1), ("max_length", "t", "b", 1),
                       ("not_null", "t", "a", 1), ("not_null", "t", "k", 1)]
    dups = quality.count_summary(quality.duplicate_keys(df, ["k"]), "primary_key", "t", "k")
    assert quality.report([s, dups]).count() == 5


def test_assert_clean_gate(spark):
    import pytest
    df = spark.createDataFrame([(1, "SI"), (None, "XX")], "k int, a string")
    s = quality.summary(df, "t", not_null=["k"], domains={"a": ["SI", "NO"]})
    with pytest.raises(quality.QualityError, match="not_null t.k: 1"):
        quality.assert_clean(s)
    quality.assert_clean(s, tolerated=[("not_null", "t", "k"), ("domain", "t", "a")])


def test_orphan_keys_aggregates_before_the_join(spark):
    from pyspark.sql import functions as F
    fact = spark.createDataFrame([(1, 10), (2, 11), (3, 11), (4, None), (5, 10)], "id int, fk int")
    dim = spark.createDataFrame([(10,)], "pk int")
    assert rows(quality.orphan_keys(fact, dim, "fk", "pk")) == [(11, 2), (None, 1)]
    s = quality.foreign_key_summary(fact, dim, "fk", "pk", "t", "fk").first()
    assert s["violations"] == quality.orphans(fact, dim, "fk", "pk").count() == 3
    plan = plan_text(quality.orphan_keys(fact, dim, "fk", "pk"))
    assert "partial_count" in plan
    clean = quality.foreign_key_summary(fact.where(F.col("fk") == 10), dim, "fk", "pk", "t", "fk")
    assert clean.first()["violations"] == 0


def test_null_violations_follow_the_declared_schema(spark):
    from clinilake import schemas
    df = spark.createDataFrame([(1, "10", None), (None, None, "x")],
                               "SPEID int, SPENAME string, SPEGRP_ID string")
    out = quality.null_violations(df, schemas.DIM_SPECIALITY, "dim_speciality")
    # SPEID, SPENAME and SPEGRP_ID are declared non-null.
    assert rows(out, "column_name", "violations") == [("SPEGRP_ID", 1), ("SPEID", 1), ("SPENAME", 1)]


def test_filtered_orphans_equal_the_plain_ones(spark):
    fact = spark.range(3000).select(
        F.when(F.col("id") % 50 != 0, (F.col("id") * 7) % 2000).alias("k"), F.col("id").alias("missing"), F.lit("x").alias("bits"))
    dim = spark.range(0, 2000, 3).select(F.col("id").cast("int").alias("pk")).unionByName(
        spark.range(2).select(F.lit(None).cast("int").alias("pk")))
    want = rows(quality.orphans(fact, dim, "k", "pk"))
    for bits in (64, 1 << 10, 1 << 16):  # full, crowded and roomy filters
        assert rows(quality.filtered_orphans(fact, dim, "k", "pk", bits)) == want
    assert rows(quality.filtered_orphans(fact, dim.limit(0), "k", "pk")) == rows(fact)
    assert quality.filtered_orphans(fact.limit(0), dim, "k", "pk").count() == 0
    two = fact.withColumn("t", F.col("k").cast("string"))
    pairs = dim.select("pk", F.col("pk").cast("string").alias("name"))
    assert rows(quality.filtered_orphans(two, pairs, ["k", "t"], ["pk", "name"])) == rows(
        quality.orphans(two, pairs, ["k", "t"], ["pk", "name"]))


def test_the_filter_keeps_most_orphans_from_the_join(spark):
    dim = spark.range(20_000)
    fact = spark.range(10_000, 50_000).select(F.col("id").alias("k"))
    told = quality.surely_missing(fact, ["k"], quality.key_filter(dim, 1 << 20), "gone", 1 << 20)
    assert told.where("gone and k < 20000").count() == 0
    assert told.where("not gone and k >= 20000").count() < 30_000 * 0.005
    assert told.columns == ["k", "gone"]
    row = quality.key_filter(dim, 1 << 12).first()["bits"]
    assert len(row) == (1 << 12) // 64 and sum(bin(x & (2**64 - 1)).count("1") for x in row) > 4000
