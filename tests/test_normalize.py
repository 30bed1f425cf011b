import datetime as dt

from clinilake.operators import normalize
from clinilake.operators.synth import DIAGNOSES
from clinilake.sources import literal_table
from clinilake import schemas

from conftest import rows


def test_split_person_name(spark):
    names = ["", "ANA", "ANA GOMEZ", "ANA MARIA GOMEZ", "ANA MARIA GOMEZ PEREZ",
             "ANA  MARIA GOMEZ DE LA", None, "   "]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    out = df.select(normalize.split_person_name("n").alias("s")).select("s.*").collect()
    assert [tuple(r) for r in out] == [
        (None, None, None), ("ANA", None, None), ("ANA", None, "GOMEZ"),
        ("ANA", "MARIA", "GOMEZ"), ("ANA", "MARIA", "GOMEZ PEREZ"), ("ANA", "MARIA", "GOMEZ DE LA"),
        (None, None, None), (None, None, None)]


def test_extract_dimension(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "b"), (4, None), (5, "c")], "id int, code string")
    dim, fact = normalize.extract_dimension(df, "code", "CODE_ID", "DESC", partitions=2)
    assert rows(dim) == [(1, "a"), (2, "b"), (3, "c")]
    assert fact.columns == ["id", "CODE_ID"]
    assert rows(fact) == [(1, 2), (2, 1), (3, 2), (4, None), (5, 3)]


def test_bronze_to_silver(spark):
    patient = spark.createDataFrame(
        [(1, "100", " maría  josé Pérez ", "Bogotá", dt.datetime(2024, 1, 1))],
        schemas.BRONZE_PATIENT)
    out = normalize.erp_patient(patient).first()
    assert (out["FIRST_NAME"], out["SECOND_NAME"], out["LAST_NAME"], out["PACCITY"]) == (
        "MARIA", "JOSE", "PEREZ", "BOGOTA")
    att = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1), "Asignado", "Sí", 1, 3),
         (2, dt.datetime(2024, 1, 2), "Cancelado", "No", 1, 3),
         (3, dt.datetime(2024, 1, 3), "asignado", "SI", 2, 4)], schemas.BRONZE_ATTENTION)
    fact, assign, assist = normalize.erp_attention(att)
    assert rows(assign) == [(1, "ASIGNADO"), (2, "CANCELADO")]
    assert rows(assist) == [(1, "NO"), (2, "SI")]
    assert rows(fact, "ATTID", "ASSIGNMENT_STATUS_ID", "ASSISTANCE_STATUS_ID") == [
        (1, 1, 2), (2, 2, 1), (3, 1, 2)]
    spec = spark.createDataFrame([(1, "Pediatría", "Clínica"), (2, "Cirugía", "Quirúrgica"),
                                  (3, "Medicina", "clinica")], schemas.BRONZE_SPECIALITY)
    s, g = normalize.erp_speciality(spec)
    assert rows(g) == [(1, "CLINICA"), (2, "QUIRURGICA")]
    assert rows(s) == [(1, "PEDIATRIA", 1), (2, "CIRUGIA", 2), (3, "MEDICINA", 1)]


def test_diagnosis_fact_matches_code_or_description(spark):
    long = spark.createDataFrame(
        [("100", dt.date(2023, 1, 1), "A00"), ("100", dt.date(2023, 2, 1), "Asma"),
         ("200", dt.date(2023, 1, 1), "J45"), ("100", dt.date(2023, 3, 1), "Gripe"),
         ("100", None, "A00")], "DOCUMENTO string, FECHA date, DIAGNOSTICO string")
    patients = spark.createDataFrame([(1, "100")], "PACID int, PACDOC string")
    catalogue = literal_table(spark, DIAGNOSES, schemas.DIM_DIAGNOSIS)
    fact, rejects = normalize.diagnosis_fact(long, patients, catalogue)
    assert rows(fact) == [(1, 1, 1, dt.date(2023, 1, 1)), (2, 1, 8, dt.date(2023, 2, 1))]
    assert rows(rejects, "DOCUMENTO", "reason") == [
        ("100", "unknown diagnosis"), ("100", "unparsed month"), ("200", "unknown patient")]


def test_diagnosis_fact_never_multiplies(spark):
    long = spark.createDataFrame([("100", dt.date(2023, 1, 1), "A00"), ("100", dt.date(2023, 1, 1), "asma"),
                                  ("200", dt.date(2023, 1, 1), "A00")],
                                 "DOCUMENTO string, FECHA date, DIAGNOSTICO string")
    patients = spark.createDataFrame([(7, "100"), (5, "100"), (9, None)], "PACID long, PACDOC string")
    catalogue = spark.createDataFrame([(3, "A00", "ASMA"), (2, "a00 ", "Asma"), (4, "J45", " asma")],
                                      "DIAG_ID long, CIE10_CODE string, DESCRIPTION string")
    fact, rejects = normalize.diagnosis_fact(long, patients, catalogue)
    assert rows(fact, "PACID", "DIAG_ID") == [(5, 2), (5, 2)]
    assert rows(rejects, "DOCUMENTO", "reason") == [("200", "unknown patient")]


def test_bad_values_become_rejects(spark):
    bronze = spark.createDataFrame([("x1", "1", "ana", "cali", None), ("2", None, "eva", "cali", None),
                                    ("3000000000", "3", "luz", "cali", "2024-01-01 00:00:00"),
                                    ("4", "4", None, None, "soon")],
                                   "PACID string, PACDOC string, PACNAME string, PACCITY string, PACINGDAT string")
    assert rows(normalize.erp_patient(bronze), "PACID", "FIRST_NAME") == [(3000000000, "LUZ")]
    assert rows(normalize.erp_rejects(bronze, "patient"), "key", "reason") == [
        ("2", "PACDOC is missing"), ("4", "PACINGDAT is not a timestamp"), ("x1", "PACID is not a long")]


def test_conform_keeps_large_ids_and_refuses_lost_keys(spark):
    import pytest
    big = spark.createDataFrame([(3_000_000_000, 1, 1, dt.date(2024, 1, 1))],
                                "PATDIAG_ID long, PACID long, DIAG_ID int, DATE date")
    assert schemas.conform(big, schemas.FACT_PATIENT_DIAGNOSIS).first()["PATDIAG_ID"] == 3_000_000_000
    bad = spark.createDataFrame([("one", "x")], "SPEGRP_ID string, SPEGRP_NAME string")
    with pytest.raises(Exception, match="SPEGRP_ID does not fit"):
        schemas.conform(bad, schemas.DIM_SPECIALITY_GROUP).collect()
