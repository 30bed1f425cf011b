import datetime as dt

from pyspark.sql import functions as F

from clinilake.operators import quality, synth

from conftest import rows


def test_generated_tables_are_consistent(spark):
    s = synth.silver(spark, 500, 2000, 800, seed=11)
    pat, att, dia = s["dim_patient"], s["fact_attention"], s["fact_patient_diagnosis"]
    assert pat.count() == 500 and pat.select("PACDOC").distinct().count() == 500
    assert pat.where(~F.col("PACDOC").rlike("^[1-9][0-9]{9}$")).count() == 0
    assert 0.3 < pat.where(F.col("SECOND_NAME").isNull()).count() / 500 < 0.7
    assert quality.orphans(att, pat, "PACID").count() == 0
    assert quality.orphans(dia, pat, "PACID").count() == 0
    assert quality.orphans(att, s["dim_speciality"], "SPEID").count() == 0
    hi = synth.DEFAULT_AS_OF.replace(tzinfo=dt.timezone.utc)
    lo = hi - dt.timedelta(days=366)
    assert att.where((F.col("ATTFIN01") < lo) | (F.col("ATTFIN01") > hi)).count() == 0
    for name, table in s.items():
        assert table.schema == synth.schemas.ALL[name] or [f.name for f in table.schema] == \
            [f.name for f in synth.schemas.ALL[name]], name


def test_same_rows_on_any_partitioning(spark):
    a = synth.attentions(spark, 1000, 50, seed=2)
    b = synth.attentions(spark, 1000, 50, seed=2).repartition(7)
    assert rows(a) == rows(b)
    c = synth.attentions(spark, 1000, 50, seed=3)
    assert rows(a) != rows(c)


def test_fixed_catalogues_and_time_dimension(spark):
    assert rows(synth.specialities(spark), "SPENAME")[0] == ("CIRUGIA GENERAL",)
    assert synth.diagnoses(spark).count() == 10
    t = synth.dim_time(spark, dt.date(2024, 1, 1), dt.date(2024, 12, 31))
    assert t.count() == 366 and t.agg(F.max("DATE")).first()[0] == dt.date(2024, 12, 31)
