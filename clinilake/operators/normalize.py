"""Bronze -> silver normalisation.

The documented design splits the patient name, turns coded columns into
dimensions with surrogate keys, and links the long diagnosis table to
patients and the ICD-10 catalogue.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinilake.functions import normalize_text
from clinilake.names import col as column, fresh
from clinilake.operators.ordered import dense_index, row_index


def split_person_name(col: Column | str) -> Column:
    """``struct(FIRST_NAME, SECOND_NAME, LAST_NAME)`` from a full name.

    Tokens are separated by whitespace runs.  1 token -> first; 2 -> first,
    last; 3 -> first, second, last; 4 or more -> first, second, and the rest
    joined by one space as last name.  Null or blank -> all null.
    """
    c = F.col(col) if isinstance(col, str) else col
    tokens = F.filter(F.split(F.trim(c), r"\s+"), lambda t: t != "")
    n = F.size(tokens)
    first = F.when(n >= 1, F.element_at(tokens, 1))
    second = F.when(n >= 3, F.element_at(tokens, 2))
    last = (F.when(n == 2, F.element_at(tokens, 2))
              .when(n == 3, F.element_at(tokens, 3))
              .when(n >= 4, F.array_join(F.slice(tokens, 3, F.greatest(n - 2, F.lit(1))), " ")))
    return F.struct(first.alias("FIRST_NAME"), second.alias("SECOND_NAME"), last.alias("LAST_NAME"))


def extract_dimension(df: DataFrame, col: str, key: str, value: str | None = None,
                      partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Turn a coded column into a dimension and a foreign key.

    Returns ``(dim, fact)``: ``dim(key, value)`` numbers the distinct non-null
    codes 1..n in sorted order (long keys, stable across runs; across loads of
    more codes use :func:`extend_dimension`); ``fact`` is ``df`` with ``col``
    replaced by ``key`` (null stays null).  The join back
    broadcasts the dimension when Spark finds it small and otherwise
    sort-merges; it is never forced.
    """
    value = value or col
    dim = (dense_index(df.where(column(col).isNotNull()), [col], key, partitions)
           .select(column(key), column(col).alias(value)))
    return dim, attach_dimension(df, col, dim, key, value)


def attach_dimension(df: DataFrame, col: str, dim: DataFrame, key: str,
                     value: str | None = None) -> DataFrame:
    """Replace the code ``col`` of ``df`` by the dimension's ``key``.

    Use with a dimension already written (or checkpointed) so the fact's plan
    reads it instead of recomputing the distinct codes.
    """
    value = value or col
    k, code = fresh(["key", "code"], df.columns)
    codes = dim.select(column(key).alias(k), column(value).alias(code))
    return (df.join(codes, column(col) == F.col(code), "left")
              .select(*[F.col(k).alias(key) if c == col else column(c) for c in df.columns]))


def new_codes(df: DataFrame, col: str, dim: DataFrame, key: str, value: str | None = None,
              partitions: int | None = None) -> DataFrame:
    """``(key, value)`` rows for the codes of ``df`` that ``dim`` does not have.

    Keys that were given stay: only new codes (an anti join) are numbered, in
    sorted order, from the dimension's largest key on (1 for an empty one).  Append the
    rows to the dimension; a load that is repeated finds no new codes.
    """
    value = value or col
    (known,) = fresh(["known"], [col, key, value])
    codes = df.where(column(col).isNotNull()).select(column(col).alias(value)).distinct()
    fresh_codes = codes.join(dim.select(column(value).alias(known)), column(value) == F.col(known), "left_anti")
    last = dim.agg(F.coalesce(F.max(column(key)), F.lit(0))).scalar()
    return (row_index(fresh_codes, [value], key, partitions, copies=False)
            .select((column(key) + last).cast("long").alias(key), column(value)))


def extend_dimension(df: DataFrame, col: str, dim: DataFrame, key: str, value: str | None = None,
                     partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Like :func:`extract_dimension` on top of a dimension from earlier loads:
    ``(dim, fact)``, where every known code keeps its key."""
    value = value or col
    whole = dim.select(column(key), column(value)).unionByName(new_codes(df, col, dim, key, value, partitions))
    return whole, attach_dimension(df, col, whole, key, value)


# Typed columns of the bronze tables and the types they get; a value that does
# not convert makes its row a reject.  Key columns must also be present.
_ERP_TYPES = {
    "patient": {"PACID": "long", "PACINGDAT": "timestamp"},
    "attention": {"ATTID": "long", "ATTFIN04": "long", "ATTFIN05": "long", "ATTFIN01": "timestamp"},
    "speciality": {"SPEID": "long"},
}
_ERP_KEYS = {"patient": ["PACID", "PACDOC"], "attention": ["ATTID", "ATTFIN04", "ATTFIN05", "ATTFIN01"],
             "speciality": ["SPEID"]}


def _reason(table: str) -> Column:
    """Why a bronze row cannot become a silver one, or null."""
    out = F.lit(None).cast("string")
    for name, kind in reversed(_ERP_TYPES[table].items()):
        bad = F.col(name).isNotNull() & F.col(name).cast("string").try_cast(kind).isNull()
        out = F.when(bad, F.lit(f"{name} is not a {kind}")).otherwise(out)
    for name in reversed(_ERP_KEYS[table]):
        out = F.when(F.col(name).isNull(), F.lit(f"{name} is missing")).otherwise(out)
    return out


def _typed(bronze: DataFrame, table: str) -> DataFrame:
    """The rows without a reason, typed columns converted."""
    types = _ERP_TYPES[table]
    return bronze.where(_reason(table).isNull()).select(
        *[column(c).try_cast(types[c]).alias(c) if c in types else column(c) for c in bronze.columns])


def erp_rejects(bronze: DataFrame, table: str) -> DataFrame:
    """Rows of a bronze table (``patient``, ``attention``, ``speciality``) that
    do not convert, as ``(table_name, key, reason, row)``; the row is JSON text.

    With the silver rows of the table they make up all of its rows.
    """
    (reason,) = fresh(["reason"], bronze.columns)
    return (bronze.withColumn(reason, _reason(table)).where(F.col(reason).isNotNull())
            .select(F.lit(table).alias("table_name"), F.col(_ERP_KEYS[table][0]).cast("string").alias("key"),
                    F.col(reason).alias("reason"),
                    F.to_json(F.struct(*[column(c) for c in bronze.columns])).alias("row")))


def erp_patient(bronze: DataFrame) -> DataFrame:
    """Bronze ``Patient`` -> ``dim_patient`` (N1 + text normalisation)."""
    name = split_person_name(normalize_text("PACNAME"))
    return _typed(bronze, "patient").select(
        "PACID", F.col("PACDOC").cast("string").alias("PACDOC"),
        name["FIRST_NAME"].alias("FIRST_NAME"), name["SECOND_NAME"].alias("SECOND_NAME"),
        name["LAST_NAME"].alias("LAST_NAME"), normalize_text("PACCITY").alias("PACCITY"), "PACINGDAT")


def erp_attention(bronze: DataFrame, partitions: int | None = None
                  ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Bronze ``Attention`` -> ``(fact_attention, dim_assignment_status,
    dim_assistance_status)`` (N2, N6)."""
    coded = erp_attention_coded(bronze)
    assign, fact = extract_dimension(coded, "ATTFIN02", "ASSIGNMENT_STATUS_ID", "STATUS_DESC", partitions)
    assist, fact = extract_dimension(fact, "ATTFIN03", "ASSISTANCE_STATUS_ID", "ASSISTED", partitions)
    fact = fact.select("ATTID", "PACID", "SPEID", "ATTFIN01", "ASSIGNMENT_STATUS_ID",
                       "ASSISTANCE_STATUS_ID")
    return fact, assign, assist


def erp_attention_coded(bronze: DataFrame) -> DataFrame:
    """Bronze ``Attention`` with silver names and normalised status texts."""
    return _typed(bronze, "attention").select(
        "ATTID", F.col("ATTFIN04").alias("PACID"), F.col("ATTFIN05").alias("SPEID"), "ATTFIN01",
        normalize_text("ATTFIN02").alias("ATTFIN02"), normalize_text("ATTFIN03").alias("ATTFIN03"))


def erp_speciality_coded(bronze: DataFrame) -> DataFrame:
    """Bronze ``Speciality`` with normalised texts."""
    return _typed(bronze, "speciality").select(
        "SPEID", normalize_text("SPENAME").alias("SPENAME"), normalize_text("SPEGRP").alias("SPEGRP"))


def erp_speciality(bronze: DataFrame, partitions: int | None = None
                   ) -> tuple[DataFrame, DataFrame]:
    """Bronze ``Speciality`` -> ``(dim_speciality, dim_speciality_group)``."""
    group, spec = extract_dimension(erp_speciality_coded(bronze), "SPEGRP", "SPEGRP_ID", "SPEGRP_NAME", partitions)
    return spec.select("SPEID", "SPENAME", "SPEGRP_ID"), group


def diagnosis_matches(long: DataFrame, patients: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Long diagnoses with ``PACID``, ``DIAG_ID`` and a ``reason`` (null when
    the row is good): step one of :func:`diagnosis_fact`.

    ``DOCUMENTO`` is matched to ``dim_patient.PACDOC``; ``DIAGNOSTICO`` to an
    ICD-10 code, else to the normalised description.  A document, code or
    description that repeats stands for its lowest id, so no row multiplies.
    """
    diag = F.upper(F.trim(F.col("DIAGNOSTICO")))
    keyed = long.select("DOCUMENTO", "FECHA", "DIAGNOSTICO", diag.alias("_code"),
                        normalize_text("DIAGNOSTICO").alias("_desc"))
    pats = patients.groupBy(F.col("PACDOC").alias("_doc")).agg(F.min("PACID").alias("PACID"))
    by_code = catalogue.groupBy(F.upper(F.trim("CIE10_CODE")).alias("_c")).agg(F.min("DIAG_ID").alias("_id_code"))
    by_desc = catalogue.groupBy(normalize_text("DESCRIPTION").alias("_d")).agg(F.min("DIAG_ID").alias("_id_desc"))
    matched = (keyed.join(pats, keyed["DOCUMENTO"] == pats["_doc"], "left")
                    .join(by_code, F.col("_code") == F.col("_c"), "left")
                    .join(by_desc, F.col("_desc") == F.col("_d"), "left")
                    .withColumn("DIAG_ID", F.coalesce("_id_code", "_id_desc")))
    reason = (F.when(F.col("PACID").isNull(), F.lit("unknown patient"))
                .when(F.col("DIAG_ID").isNull(), F.lit("unknown diagnosis"))
                .when(F.col("FECHA").isNull(), F.lit("unparsed month")))
    return matched.select("DOCUMENTO", "FECHA", "DIAGNOSTICO", "PACID", "DIAG_ID", reason.alias("reason"))


def diagnosis_rejects(matches: DataFrame) -> DataFrame:
    """The matches that have a reason not to become facts."""
    return matches.where(F.col("reason").isNotNull()).select("DOCUMENTO", "FECHA", "DIAGNOSTICO", "reason")


def numbered_diagnoses(matches: DataFrame) -> DataFrame:
    """The good matches as facts, numbered in ``(DOCUMENTO, FECHA, DIAGNOSTICO)`` order."""
    good = matches.where(F.col("reason").isNull()).select(
        "DOCUMENTO", "FECHA", "DIAGNOSTICO", "PACID", "DIAG_ID")
    return (row_index(good, ["DOCUMENTO", "FECHA", "DIAGNOSTICO", "DIAG_ID"], "PATDIAG_ID")
            .select("PATDIAG_ID", "PACID", "DIAG_ID", F.col("FECHA").alias("DATE")))


def split_diagnoses(matches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Step two of :func:`diagnosis_fact`: ``(fact, rejects)`` from the matches."""
    return numbered_diagnoses(matches), diagnosis_rejects(matches)


def diagnosis_fact(long: DataFrame, patients: DataFrame, catalogue: DataFrame
                   ) -> tuple[DataFrame, DataFrame]:
    """Long diagnoses -> ``(fact_patient_diagnosis, rejects)``.

    ``DOCUMENTO`` is matched to ``dim_patient.PACDOC``; ``DIAGNOSTICO`` to an
    ICD-10 code, else to the normalised description.  Rows matching no
    patient or no diagnosis go to ``rejects`` with a reason.  ``PATDIAG_ID``
    numbers the facts 1..n in ``(DOCUMENTO, FECHA, DIAGNOSTICO)`` order.
    Every input row lands in exactly one of the two outputs, also where
    documents, codes or descriptions repeat (see :func:`diagnosis_matches`).
    """
    return split_diagnoses(diagnosis_matches(long, patients, catalogue))
