import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from clinilake.operators import gold

from conftest import rows

D = dt.datetime


def _appointments(spark):
    return spark.createDataFrame(
        [(1, "A", D(2024, 1, 10)), (2, "A", D(2024, 1, 1)), (3, "A", D(2024, 1, 31)),
         (4, "B", D(2024, 2, 1)), (5, "C", D(2024, 3, 1, 8)), (6, "C", D(2024, 3, 1, 8)),
         (7, "D", D(2024, 1, 1)), (8, "D", D(2024, 1, 2, 12))],
        "ATTID int, PACDOC string, FECHA_ATENCION timestamp")


def test_mean_gap_equals_mean_of_lag_gaps(spark):
    df = _appointments(spark)
    got = {r["PACDOC"]: r for r in gold.mean_gap(df).collect()}
    assert got["A"]["mean_gap_days"] == 15.0 and got["A"]["appointments"] == 3
    assert got["B"]["mean_gap_days"] is None
    assert got["C"]["mean_gap_days"] == 0.0
    assert got["D"]["mean_gap_hours"] == 36.0
    w = Window.partitionBy("PACDOC").orderBy("FECHA_ATENCION", "ATTID")
    lagged = df.select("PACDOC", F.datediff("FECHA_ATENCION", F.lag("FECHA_ATENCION").over(w)).alias("g"))
    means = {r[0]: r[1] for r in lagged.groupBy("PACDOC").agg(F.avg("g")).collect()}
    assert all(means[k] == got[k]["mean_gap_days"] for k in got)


def test_appointment_gaps(spark):
    out = gold.appointment_gaps(_appointments(spark), partitions=3)
    assert out.columns == ["PACDOC", "ATTID", "FECHA_ATENCION", "prev_ATTID", "prev_FECHA_ATENCION", "gap_days"]
    assert rows(out, "PACDOC", "ATTID", "prev_ATTID", "gap_days") == [
        ("A", 1, 2, 9), ("A", 3, 1, 21), ("C", 6, 5, 0), ("D", 8, 7, 1)]


def test_counts_and_months(spark):
    df = _appointments(spark).withColumn("SPENAME", F.lit("PEDIATRIA"))
    assert rows(gold.attention_counts(df), "PACDOC", "attentions") == [
        ("A", 3), ("B", 1), ("C", 2), ("D", 2)]
    diag = spark.createDataFrame([(1, dt.date(2024, 1, 5)), (1, dt.date(2024, 1, 30)),
                                  (2, dt.date(2024, 2, 1))], "DIAG_ID int, DATE date")
    assert rows(gold.diagnosis_by_month(diag)) == [(1, dt.date(2024, 1, 1), 2), (2, dt.date(2024, 2, 1), 1)]


def test_count_by_equals_counting_the_joined_view(spark):
    from clinilake.operators.joins import Dim, star_join
    fact = spark.createDataFrame([(1, 10, "A"), (2, 10, "A"), (3, 20, "B"), (4, 30, "A"), (5, None, "A")],
                                 "id int, pk int, flag string")
    dim = spark.createDataFrame([(10, "x"), (20, "y"), (20, "y"), (30, "x")], "pk int, name string")
    flags = spark.createDataFrame([("A", "ACC"), ("B", "BAD")], "code string, descr string")
    dims = [Dim(dim, "d", [("pk", "pk")]), Dim(flags, "g", [("flag", "code")])]
    view = star_join(fact, dims, ["d.name", "g.descr"]).groupBy("name", "descr").count()
    pre = gold.count_by(fact, dims, ["d.name", "g.descr"], "count")
    assert rows(pre) == rows(view) == [("x", "ACC", 3), ("y", "BAD", 2)]


def test_mean_gap_ignores_rows_without_a_timestamp(spark):
    df = spark.createDataFrame([("A", D(2024, 1, 1)), ("A", D(2024, 1, 11)), ("A", None), ("B", None)],
                               "PACDOC string, FECHA_ATENCION timestamp")
    got = {r["PACDOC"]: r for r in gold.mean_gap(df).collect()}
    assert got["A"]["mean_gap_days"] == 10.0 and got["A"]["appointments"] == 3
    assert got["B"]["mean_gap_days"] is None and got["B"]["appointments"] == 1


def test_gaps_after_a_null_tiebreak(spark):
    df = spark.createDataFrame([(None, "A", D(2024, 1, 1)), (2, "A", D(2024, 1, 4))],
                               "ATTID int, PACDOC string, FECHA_ATENCION timestamp")
    assert rows(gold.appointment_gaps(df), "ATTID", "prev_ATTID", "gap_days") == [(2, None, 3)]


def test_count_by_shared_names_and_fact_columns(spark):
    from clinilake.operators.joins import Dim
    fact = spark.createDataFrame([(1, 10, "A"), (2, 10, "B"), (3, 20, "A")], "id int, k int, flag string")
    one = spark.createDataFrame([(10, "x"), (20, "y")], "k int, name string")
    two = spark.createDataFrame([("A", "x"), ("B", "z")], "code string, name string")
    dims = [Dim(one, "d", [("k", "k")]), Dim(two, "e", [("flag", "code")])]
    out = gold.count_by(fact, dims, ["d.name", "e.name", "f.flag"])
    assert out.columns == ["d.name", "e.name", "flag", "attentions"]
    assert rows(out.toDF("a", "b", "c", "n")) == [("x", "x", "A", 1), ("x", "z", "B", 1), ("y", "x", "A", 1)]
