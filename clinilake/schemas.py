"""Silver-zone schemas (C6) and empty tables built from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (DateType, LongType, StringType, StructField,
                               StructType, TimestampType)


def _fields(*spec: tuple[str, object, bool]) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in spec])


# All ids are long: fact ids pass 2**31 at the scale this is for.
ID, STR, TS, DATE = LongType(), StringType(), TimestampType(), DateType()

# Table and field names of the documented model.

DIM_PATIENT = _fields(
    ("PACID", ID, False), ("PACDOC", STR, False), ("FIRST_NAME", STR, True),
    ("SECOND_NAME", STR, True), ("LAST_NAME", STR, True), ("PACCITY", STR, True),
    ("PACINGDAT", TS, True))
DIM_SPECIALITY = _fields(("SPEID", ID, False), ("SPENAME", STR, False),
                         ("SPEGRP_ID", ID, False))
DIM_SPECIALITY_GROUP = _fields(("SPEGRP_ID", ID, False), ("SPEGRP_NAME", STR, False))
DIM_DIAGNOSIS = _fields(("DIAG_ID", ID, False), ("CIE10_CODE", STR, False),
                        ("DESCRIPTION", STR, True))
DIM_ASSIGNMENT_STATUS = _fields(("ASSIGNMENT_STATUS_ID", ID, False),
                                ("STATUS_DESC", STR, False))
DIM_ASSISTANCE_STATUS = _fields(("ASSISTANCE_STATUS_ID", ID, False),
                                ("ASSISTED", STR, False))
FACT_ATTENTION = _fields(
    ("ATTID", ID, False), ("PACID", ID, False), ("SPEID", ID, False),
    ("ATTFIN01", TS, False), ("ASSIGNMENT_STATUS_ID", ID, False),
    ("ASSISTANCE_STATUS_ID", ID, False))
FACT_PATIENT_DIAGNOSIS = _fields(("PATDIAG_ID", ID, False), ("PACID", ID, False),
                                 ("DIAG_ID", ID, False), ("DATE", DATE, False))

# Gold outputs.
ATENCION_DETALLE = _fields(
    ("ATTID", ID, True), ("FECHA_ATENCION", TS, True), ("PACID", ID, True),
    ("PACDOC", STR, True), ("FIRST_NAME", STR, True), ("SECOND_NAME", STR, True),
    ("LAST_NAME", STR, True), ("PACCITY", STR, True), ("PACINGDAT", TS, True),
    ("SPENAME", STR, True), ("SPEGRP_NAME", STR, True),
    ("ESTADO_ASIGNACION", STR, True), ("ASISTENCIA", STR, True))
DIAGNOSTICOS_TRANSFORMADOS = _fields(("DOCUMENTO", STR, True), ("FECHA", DATE, True),
                                     ("DIAGNOSTICO", STR, True))

# Bronze ERP tables as documented (types are ours).
BRONZE_PATIENT = _fields(("PACID", ID, True), ("PACDOC", STR, True),
                         ("PACNAME", STR, True), ("PACCITY", STR, True),
                         ("PACINGDAT", TS, True))
BRONZE_ATTENTION = _fields(("ATTID", ID, True), ("ATTFIN01", TS, True),
                           ("ATTFIN02", STR, True), ("ATTFIN03", STR, True),
                           ("ATTFIN04", ID, True), ("ATTFIN05", ID, True))
BRONZE_SPECIALITY = _fields(("SPEID", ID, True), ("SPENAME", STR, True),
                            ("SPEGRP", STR, True))

ALL: dict[str, StructType] = {
    "dim_patient": DIM_PATIENT,
    "dim_speciality": DIM_SPECIALITY,
    "dim_speciality_group": DIM_SPECIALITY_GROUP,
    "dim_diagnosis": DIM_DIAGNOSIS,
    "dim_assignment_status": DIM_ASSIGNMENT_STATUS,
    "dim_assistance_status": DIM_ASSISTANCE_STATUS,
    "fact_attention": FACT_ATTENTION,
    "fact_patient_diagnosis": FACT_PATIENT_DIAGNOSIS,
}

# Columns of the silver tables declared with a maximum text length in the
# logical model (fixed values of the documented design).
MAX_LENGTH: dict[str, dict[str, int]] = {
    "dim_patient": {"FIRST_NAME": 30, "SECOND_NAME": 30, "LAST_NAME": 30, "PACCITY": 30},
    "dim_diagnosis": {"CIE10_CODE": 30, "DESCRIPTION": 45},
    "dim_speciality": {"SPENAME": 45},
    "dim_speciality_group": {"SPEGRP_NAME": 45},
    "dim_assignment_status": {"STATUS_DESC": 45},
}

# Enumerated domains of the logical model (fixed values).
DOMAINS: dict[str, dict[str, list[str]]] = {
    "dim_assistance_status": {"ASSISTED": ["SI", "NO"]},
}

# Primary and foreign keys of the constellation: (table, column) -> (table, column).
PRIMARY_KEYS: dict[str, list[str]] = {
    "dim_patient": ["PACID"], "dim_speciality": ["SPEID"],
    "dim_speciality_group": ["SPEGRP_ID"], "dim_diagnosis": ["DIAG_ID"],
    "dim_assignment_status": ["ASSIGNMENT_STATUS_ID"],
    "dim_assistance_status": ["ASSISTANCE_STATUS_ID"],
    "fact_attention": ["ATTID"], "fact_patient_diagnosis": ["PATDIAG_ID"],
}
FOREIGN_KEYS: list[tuple[str, str, str, str]] = [
    ("fact_patient_diagnosis", "PACID", "dim_patient", "PACID"),
    ("fact_patient_diagnosis", "DIAG_ID", "dim_diagnosis", "DIAG_ID"),
    ("fact_attention", "PACID", "dim_patient", "PACID"),
    ("fact_attention", "SPEID", "dim_speciality", "SPEID"),
    ("dim_speciality", "SPEGRP_ID", "dim_speciality_group", "SPEGRP_ID"),
    ("fact_attention", "ASSIGNMENT_STATUS_ID", "dim_assignment_status", "ASSIGNMENT_STATUS_ID"),
    ("fact_attention", "ASSISTANCE_STATUS_ID", "dim_assistance_status", "ASSISTANCE_STATUS_ID"),
]


def empty(spark: SparkSession, name: str) -> DataFrame:
    """An empty DataFrame with the named silver schema."""
    return spark.createDataFrame([], ALL[name])


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select and cast ``df`` to ``schema`` by column name.

    Parquet written by other tools may carry TIMESTAMP_NTZ or narrower
    integers; casting once here keeps downstream types stable.  In a nullable
    column a value that does not convert becomes null.  In a column declared
    not null it fails the job: a key must never be lost silently.
    """
    from pyspark.sql import functions as F

    from clinilake.names import col

    def one(f: StructField):
        cast = col(f.name).try_cast(f.dataType)
        if not f.nullable:
            bad = col(f.name).isNotNull() & cast.isNull()
            cast = F.when(bad, F.raise_error(F.concat(
                F.lit(f"{f.name} does not fit {f.dataType.simpleString()}: "), col(f.name).cast("string")))
                .cast(f.dataType)).otherwise(cast)
        return cast.alias(f.name)

    return df.select([one(f) for f in schema])
