"""Synthetic silver tables (G1-G8) and a calendar dimension.

Rows come from ``spark.range`` and every random choice is
``pmod(xxhash64(id, salt, seed), n)``: the same id gives the same row on any
partitioning, and no dimension key is collected to the driver (generated keys
are dense 1..n, so a foreign key is just another hash pick).  ``as_of`` anchors
"now" so a run can be repeated.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinilake import schemas

# The catalogue rows of the silver model, already normalised
# (upper case, no accents), in key order.
SPECIALITY_GROUPS = [(1, "CLINICA"), (2, "QUIRURGICA"), (3, "DIAGNOSTICO Y TRATAMIENTO")]
SPECIALITIES = [(1, "MEDICINA INTERNA", 1), (2, "PEDIATRIA", 1), (3, "CIRUGIA GENERAL", 2),
                (4, "GINECOLOGIA", 2), (5, "RADIOLOGIA", 3)]
DIAGNOSES = [(1, "A00", "COLERA"), (2, "B01", "VARICELA"),
             (3, "C34", "TUMOR MALIGNO DE BRONQUIOS Y PULMON"), (4, "E11", "DIABETES TIPO 2"),
             (5, "F32", "EPISODIO DEPRESIVO"), (6, "G40", "EPILEPSIA"),
             (7, "I10", "HIPERTENSION ESENCIAL"), (8, "J45", "ASMA"),
             (9, "K21", "REFLUJO GASTROESOFAGICO"), (10, "M54", "DOLOR LUMBAR")]
ASSIGNMENT_STATUS = [(1, "ASIGNADO"), (2, "PENDIENTE POR ASIGNAR"), (3, "CANCELADO POR EL PACIENTE")]
ASSISTANCE_STATUS = [(1, "SI"), (2, "NO")]

# Name and city pools for generated patients (our own lists).
FIRST_NAMES = ["ANA", "ANDRES", "CAMILA", "CARLOS", "CATALINA", "DANIEL", "DIANA", "FELIPE",
               "GABRIELA", "JAVIER", "JUAN", "JULIANA", "LAURA", "LUIS", "MARIA", "MATEO",
               "NATALIA", "PAULA", "SANTIAGO", "SOFIA", "VALENTINA", "SEBASTIAN"]
LAST_NAMES = ["CASTRO", "DIAZ", "GARCIA", "GOMEZ", "GONZALEZ", "HERRERA", "JIMENEZ", "LOPEZ",
              "MARTINEZ", "MORALES", "ORTIZ", "PEREZ", "RAMIREZ", "RIVERA", "RODRIGUEZ",
              "ROJAS", "SANCHEZ", "TORRES", "VARGAS", "MUNOZ"]
CITIES = ["BOGOTA", "MEDELLIN", "CALI", "BARRANQUILLA", "CARTAGENA", "BUCARAMANGA", "PEREIRA",
          "MANIZALES", "SANTA MARTA", "IBAGUE", "CUCUTA", "PASTO"]

DOC_BASE = 1_000_000_000
DOC_SPAN = 9_000_000_000
# gcd(7654321, 9e9) == 1, so id -> (id * A + B) mod 9e9 is one-to-one below 9e9.
DOC_MULT, DOC_SHIFT = 7_654_321, 12_345
DEFAULT_AS_OF = dt.datetime(2025, 1, 1)


def _hash(salt: str, seed: int) -> Column:
    return F.xxhash64(F.col("id"), F.lit(salt), F.lit(seed))


def pick(salt: str, seed: int, n: int) -> Column:
    """Uniform-ish integer in 1..n from the row id (with replacement)."""
    return F.pmod(_hash(salt, seed), F.lit(n)) + 1


def _choose(pool: list[str], salt: str, seed: int) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in pool]), pick(salt, seed, len(pool)).cast("int"))


def _key(c: Column, n: int) -> Column:
    return c.cast("int") if n < 2 ** 31 else c.cast("long")


def _ts_before(as_of: dt.datetime, span_seconds: int, salt: str, seed: int) -> Column:
    offset = F.pmod(_hash(salt, seed), F.lit(span_seconds))
    return F.timestamp_seconds(F.lit(int(as_of.replace(tzinfo=dt.timezone.utc).timestamp())) - offset)


def _rows(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(1, n + 1)


def document_number(id_col: Column) -> Column:
    """Unique ten-digit document text for ids below 9e9, no shuffle."""
    return (F.lit(DOC_BASE) + F.pmod(id_col * F.lit(DOC_MULT) + F.lit(DOC_SHIFT),
                                     F.lit(DOC_SPAN))).cast("string")


def patients(spark: SparkSession, n: int, seed: int = 0, as_of: dt.datetime = DEFAULT_AS_OF) -> DataFrame:
    """``dim_patient`` with ``n`` rows (G1); half have a second name."""
    if n >= DOC_SPAN:
        raise ValueError("document numbers are unique only below 9e9 patients")
    return _rows(spark, n).select(
        _key(F.col("id"), n).alias("PACID"), document_number(F.col("id")).alias("PACDOC"),
        _choose(FIRST_NAMES, "first", seed).alias("FIRST_NAME"),
        F.when(F.pmod(_hash("has_second", seed), F.lit(2)) == 0,
               _choose(FIRST_NAMES, "second", seed)).alias("SECOND_NAME"),
        _choose(LAST_NAMES, "last", seed).alias("LAST_NAME"),
        _choose(CITIES, "city", seed).alias("PACCITY"),
        _ts_before(as_of, 3 * 365 * 86400, "ingress", seed).alias("PACINGDAT"))


def _literal(spark: SparkSession, rows: list[tuple], name: str) -> DataFrame:
    from clinilake.sources import literal_table
    return literal_table(spark, rows, schemas.ALL[name])


def speciality_groups(spark: SparkSession) -> DataFrame:
    return _literal(spark, SPECIALITY_GROUPS, "dim_speciality_group")  # G2


def specialities(spark: SparkSession) -> DataFrame:
    return _literal(spark, SPECIALITIES, "dim_speciality")  # G3


def diagnoses(spark: SparkSession) -> DataFrame:
    return _literal(spark, DIAGNOSES, "dim_diagnosis")  # G4


def assignment_status(spark: SparkSession) -> DataFrame:
    return _literal(spark, ASSIGNMENT_STATUS, "dim_assignment_status")  # G5


def assistance_status(spark: SparkSession) -> DataFrame:
    return _literal(spark, ASSISTANCE_STATUS, "dim_assistance_status")  # G6


def attentions(spark: SparkSession, n: int, n_patients: int, seed: int = 0,
               as_of: dt.datetime = DEFAULT_AS_OF) -> DataFrame:
    """``fact_attention`` with ``n`` rows over patients 1..n_patients."""
    return _rows(spark, n).select(
        _key(F.col("id"), n).alias("ATTID"),
        _key(pick("patient", seed, n_patients), n_patients).alias("PACID"),
        pick("speciality", seed, len(SPECIALITIES)).cast("int").alias("SPEID"),
        _ts_before(as_of, 365 * 86400, "when", seed).alias("ATTFIN01"),
        pick("assignment", seed, len(ASSIGNMENT_STATUS)).cast("int").alias("ASSIGNMENT_STATUS_ID"),
        pick("assistance", seed, len(ASSISTANCE_STATUS)).cast("int").alias("ASSISTANCE_STATUS_ID"))


def patient_diagnoses(spark: SparkSession, n: int, n_patients: int, seed: int = 0,
                      as_of: dt.datetime = DEFAULT_AS_OF) -> DataFrame:
    """``fact_patient_diagnosis`` with ``n`` rows (G8), dates in the last year."""
    return _rows(spark, n).select(
        _key(F.col("id"), n).alias("PATDIAG_ID"),
        _key(pick("patient", seed, n_patients), n_patients).alias("PACID"),
        pick("diagnosis", seed, len(DIAGNOSES)).cast("int").alias("DIAG_ID"),
        F.date_sub(F.lit(as_of.date()), F.pmod(_hash("date", seed), F.lit(365)).cast("int")).alias("DATE"))


def silver(spark: SparkSession, n_patients: int = 20, n_attentions: int = 40,
           n_diagnoses: int = 30, seed: int = 0, as_of: dt.datetime = DEFAULT_AS_OF
           ) -> dict[str, DataFrame]:
    """All eight silver tables (G9), lazily."""
    return {
        "dim_patient": patients(spark, n_patients, seed, as_of),
        "dim_speciality_group": speciality_groups(spark),
        "dim_speciality": specialities(spark),
        "dim_diagnosis": diagnoses(spark),
        "dim_assignment_status": assignment_status(spark),
        "dim_assistance_status": assistance_status(spark),
        "fact_attention": attentions(spark, n_attentions, n_patients, seed, as_of),
        "fact_patient_diagnosis": patient_diagnoses(spark, n_diagnoses, n_patients, seed, as_of),
    }


def dim_time(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day in ``[start, end]`` with calendar attributes."""
    days = (end - start).days + 1
    d = F.date_add(F.lit(start), F.col("id").cast("int"))
    return spark.range(0, days).select(
        d.alias("DATE"), F.year(d).alias("YEAR"), F.quarter(d).alias("QUARTER"),
        F.month(d).alias("MONTH"), F.dayofmonth(d).alias("DAY"),
        F.dayofweek(d).alias("DAY_OF_WEEK"), F.trunc(d, "month").alias("MONTH_START"))
