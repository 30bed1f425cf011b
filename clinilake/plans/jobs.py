"""End-to-end jobs of the health lake (points 3-6 of the design, plus the
documented bronze->silver normalisation, gold indicators and checks).

Each job reads one zone and writes another, never the same path it reads.
Run one from the command line::

    spark-submit --py-files clinilake.zip clinilake/plans/jobs.py build_detail \\
        --root s3a://lake --mode sql
"""

from __future__ import annotations

import argparse
import dataclasses
import datetime as dt
import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinilake import schemas, session, sinks, sources
from clinilake import sql as sqlfiles
from clinilake.lake import Lake
from clinilake.operators import gold, normalize, quality, synth
from clinilake.operators.joins import Dim, star_join
from clinilake.operators.ordered import row_index
from clinilake.operators.reshape import diagnoses_long, unpivot_to_dates
from clinilake.sources import rescue

log = logging.getLogger(__name__)

DETAIL_TABLES = ["dim_patient", "dim_speciality", "dim_speciality_group",
                 "dim_assignment_status", "dim_assistance_status", "fact_attention"]
NATURAL_KEY = ["PACDOC", "FECHA_ATENCION"]


def land_bronze(spark: SparkSession, lake: Lake, fmt: str, path: str, name: str,
                data_address: str = "A1", schema: str | None = None, **options: str) -> DataFrame:
    """Bronze landing (S11): a faithful copy of a source as parquet, plus the
    source file of every row.  ``fmt="xlsx"`` lands workbooks cell by cell
    (:func:`clinilake.sources.workbooks.read_workbook_cells`).  With a ``schema``
    (DDL), JSON or CSV lines land typed, and what does not fit it beside them
    (:mod:`clinilake.sources.rescue`)."""
    if fmt == "xlsx":
        from clinilake.sources.workbooks import read_workbook_cells
        raw = read_workbook_cells(spark, path, data_address).withColumn(
            "_ingested_at", F.current_timestamp())
    elif schema is not None and fmt in rescue.FORMATS:
        raw = rescue.land_lines(spark, fmt, path, schema, **options)
    else:
        raw = sources.land_raw(spark, fmt, path, **options)
    sinks.write_zone(raw, lake, "bronze", name)
    return raw


def table_audit(name: str):
    """The checks of one silver table by itself: not null, length, domain, key."""
    def audit(df: DataFrame) -> DataFrame:
        keys = schemas.PRIMARY_KEYS[name]
        return quality.report([
            quality.summary(df, name, not_null=[f.name for f in schemas.ALL[name] if not f.nullable],
                            max_length=schemas.MAX_LENGTH.get(name), domains=schemas.DOMAINS.get(name)),
            quality.count_summary(quality.duplicate_keys(df, keys), "primary_key", name, ",".join(keys))])
    return audit


def write_silver(df: DataFrame, lake: Lake, name: str, mode: str = "overwrite") -> None:
    """Write a silver table; a lake of snapshots audits it before readers see it."""
    sinks.write_zone(df, lake, "silver", name, mode, audit=table_audit(name))


def build_silver(spark: SparkSession, lake: Lake, n_patients: int = 20, n_attentions: int = 40,
                 n_diagnoses: int = 30, seed: int = 0, as_of: dt.datetime = synth.DEFAULT_AS_OF
                 ) -> dict[str, DataFrame]:
    """Generate and write the eight silver tables once each."""
    tables = synth.silver(spark, n_patients, n_attentions, n_diagnoses, seed, as_of)
    for name, df in tables.items():
        write_silver(df, lake, name)
    return tables


PATIENT_KEYED = ["dim_patient", "fact_attention", "fact_patient_diagnosis"]


def bucket_silver(spark: SparkSession, lake: Lake, buckets: int) -> list[str]:
    """Save the patient-keyed silver tables as catalog tables bucketed and
    sorted by ``PACID`` into ``buckets`` buckets.

    Joins between tables bucketed alike on the join key need no shuffle on
    either side: the large fact-to-patient join of ``atencion_detalle``
    becomes a sort-merge join of matching buckets.  Pick ``buckets`` so a
    bucket of the fact fits a task (for example fact size / 256 MB).
    """
    lake.ensure_database(spark, "silver")
    names = []
    for name in PATIENT_KEYED:
        df = sources.read_zone(spark, dataclasses.replace(lake, tables=False), "silver", name)  # the zone files
        sinks.save_table(df, lake.table("silver", name), bucket_by=(buckets, ["PACID"]))
        names.append(lake.table("silver", name))
    return names


def read_silver(spark: SparkSession, lake: Lake, names: list[str],
                bucketed: bool = False) -> dict[str, DataFrame]:
    """Silver tables from files, or the bucketed catalog copies where present."""
    out = sources.read_tables(spark, lake, names, zone="silver")
    if bucketed:
        for name in names:
            if name in PATIENT_KEYED:
                out[name] = spark.table(lake.table("silver", name))
    return out


# The dimensions of the view (table, alias, key, parent alias) and
# its output columns (qualified name, name in the view).  Both forms come from
# these two lists.
DETAIL_DIMS = [
    ("dim_patient", "p", "PACID", None),
    ("dim_speciality", "s", "SPEID", None),
    ("dim_speciality_group", "g", "SPEGRP_ID", "s"),
    ("dim_assignment_status", "a", "ASSIGNMENT_STATUS_ID", None),
    ("dim_assistance_status", "b", "ASSISTANCE_STATUS_ID", None),
]
DETAIL_COLUMNS = [
    ("f.ATTID", "ATTID"), ("f.ATTFIN01", "FECHA_ATENCION"), ("p.PACID", "PACID"), ("p.PACDOC", "PACDOC"),
    ("p.FIRST_NAME", "FIRST_NAME"), ("p.SECOND_NAME", "SECOND_NAME"), ("p.LAST_NAME", "LAST_NAME"),
    ("p.PACCITY", "PACCITY"), ("p.PACINGDAT", "PACINGDAT"), ("s.SPENAME", "SPENAME"),
    ("g.SPEGRP_NAME", "SPEGRP_NAME"), ("a.STATUS_DESC", "ESTADO_ASIGNACION"), ("b.ASSISTED", "ASISTENCIA"),
]


def detail_df(silver: dict[str, DataFrame]) -> DataFrame:
    """``atencion_detalle`` in DataFrame form."""
    dims = [Dim(silver[table], alias, [(key, key)], parent=parent) for table, alias, key, parent in DETAIL_DIMS]
    return star_join(silver["fact_attention"], dims, [F.col(c).alias(name) for c, name in DETAIL_COLUMNS])


def detail_statement() -> str:
    """``atencion_detalle`` as one SQL statement over the silver views."""
    columns = ", ".join(f"{c} as {name}" for c, name in DETAIL_COLUMNS)
    joins = "".join(f"\njoin {table} {alias} on {parent or 'f'}.{key} = {alias}.{key}"
                    for table, alias, key, parent in DETAIL_DIMS)
    return f"select {columns}\nfrom fact_attention f{joins}"


def detail_sql(spark: SparkSession, silver: dict[str, DataFrame]) -> DataFrame:
    """``atencion_detalle`` in SQL form: temp views + the statement."""
    sqlfiles.register({n: silver[n] for n in DETAIL_TABLES})
    return spark.sql(detail_statement())


def detail(spark: SparkSession, silver: dict[str, DataFrame], mode: str = "sql") -> DataFrame:
    if mode not in ("sql", "df"):
        raise ValueError("mode must be 'sql' or 'df'")
    return detail_sql(spark, silver) if mode == "sql" else detail_df(silver)


def build_detail(spark: SparkSession, lake: Lake, mode: str = "sql",
                 bucketed: bool = False) -> DataFrame:
    """Point 4: silver -> gold ``atencion_detalle`` (``bucketed=True`` reads the
    tables saved by :func:`bucket_silver`)."""
    silver = read_silver(spark, lake, DETAIL_TABLES, bucketed)
    view = detail(spark, silver, mode)
    sinks.write_zone(view, lake, "gold", "atencion_detalle")
    return view


def natural_key(spark: SparkSession, view: DataFrame, mode: str = "sql") -> DataFrame:
    """Point 5: duplicate ``(PACDOC, FECHA_ATENCION)`` groups with ``conteo``."""
    if mode == "sql":
        sqlfiles.register({"atencion_detalle": view})
        return sqlfiles.run_bundled(spark, "clave_natural")
    return quality.duplicate_keys(view, NATURAL_KEY)


def check_key(spark: SparkSession, lake: Lake, mode: str = "sql") -> tuple[bool, DataFrame]:
    """Point 5 on the written gold view: (is the pair a key?, duplicate groups)."""
    view = sources.read_zone(spark, lake, "gold", "atencion_detalle")
    dups = natural_key(spark, view, mode)
    unique = dups.isEmpty()
    if unique:
        log.info("(PACDOC, FECHA_ATENCION) is a valid natural key")
    else:
        log.warning("(PACDOC, FECHA_ATENCION) repeats; see the duplicate groups")
    return unique, dups


def transform_diagnoses(spark: SparkSession, lake: Lake, workbooks: str,
                        data_address: str = "'sheet1'!A1", literal: bool = False,
                        clean_headers: bool = False) -> DataFrame:
    """Point 6: diagnosis workbooks -> gold ``diagnosticos_transformados``.

    ``literal=True`` keeps the melt's intermediate ``MES_ANO`` step as
    written in the design; both forms give the same rows with the same
    narrow ``Expand`` plan.
    """
    wide = sources.read_workbooks(spark, workbooks, data_address).drop("_source_file")
    long = (diagnoses_long(wide, clean_headers=clean_headers) if literal
            else unpivot_to_dates(wide, clean_headers=clean_headers))
    sinks.write_zone(long, lake, "gold", "diagnosticos_transformados")
    return long


def normalize_erp(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """Bronze ERP tables -> silver dimensions and facts.

    Dimensions are written first and the facts are keyed against the written
    tables, so writing a fact never recomputes the distinct codes and a lost
    executor only repeats the fact's own stages.  Rows that do not convert go
    to bronze ``erp_rejects`` with a reason instead of stopping the job.
    """
    bronze = sources.read_tables(spark, lake, ["patient", "attention", "speciality"], zone="bronze")

    def written(name: str, df: DataFrame) -> DataFrame:
        write_silver(schemas.conform(df, schemas.ALL[name]), lake, name)
        return sources.read_zone(spark, lake, "silver", name)

    rejects = quality.report([normalize.erp_rejects(df, name) for name, df in bronze.items()])
    sinks.write_zone(rejects, lake, "bronze", "erp_rejects")
    out = {"erp_rejects": sources.read_zone(spark, lake, "bronze", "erp_rejects"),
           "dim_patient": written("dim_patient", normalize.erp_patient(bronze["patient"]))}
    spec = normalize.erp_speciality_coded(bronze["speciality"])
    group, _ = normalize.extract_dimension(spec, "SPEGRP", "SPEGRP_ID", "SPEGRP_NAME")
    out["dim_speciality_group"] = written("dim_speciality_group", group)
    out["dim_speciality"] = written("dim_speciality", normalize.attach_dimension(
        spec, "SPEGRP", out["dim_speciality_group"], "SPEGRP_ID", "SPEGRP_NAME"))
    att = normalize.erp_attention_coded(bronze["attention"])
    assign, _ = normalize.extract_dimension(att, "ATTFIN02", "ASSIGNMENT_STATUS_ID", "STATUS_DESC")
    assist, _ = normalize.extract_dimension(att, "ATTFIN03", "ASSISTANCE_STATUS_ID", "ASSISTED")
    out["dim_assignment_status"] = written("dim_assignment_status", assign)
    out["dim_assistance_status"] = written("dim_assistance_status", assist)
    fact = normalize.attach_dimension(att, "ATTFIN02", out["dim_assignment_status"],
                                      "ASSIGNMENT_STATUS_ID", "STATUS_DESC")
    fact = normalize.attach_dimension(fact, "ATTFIN03", out["dim_assistance_status"],
                                      "ASSISTANCE_STATUS_ID", "ASSISTED")
    out["fact_attention"] = written("fact_attention", fact)
    return out


def load_diagnoses(spark: SparkSession, lake: Lake, name: str = "diagnosis_catalogue") -> DataFrame:
    """A bronze catalogue (``CIE10_CODE``, ``DESCRIPTION``) -> silver ``dim_diagnosis``.

    Codes are trimmed and upper-cased; of a repeated code the smallest
    description stays.  ``DIAG_ID`` numbers the codes in order; a code that an
    earlier load has numbered keeps its row, new codes are numbered on and
    appended, so facts that were written stay right and a load may be repeated.
    """
    raw = sources.read_zone(spark, lake, "bronze", name)
    codes = raw.select(F.upper(F.trim("CIE10_CODE")).alias("CIE10_CODE"), F.trim("DESCRIPTION").alias("DESCRIPTION"))
    known = codes.where("CIE10_CODE <> ''").groupBy("CIE10_CODE").agg(F.min("DESCRIPTION").alias("DESCRIPTION"))
    try:
        old = sources.read_zone(spark, lake, "silver", "dim_diagnosis")
    except (AnalysisException, FileNotFoundError):
        dim, mode = row_index(known, ["CIE10_CODE"], "DIAG_ID", copies=False), "overwrite"
    else:
        ids = session.checkpointed(normalize.new_codes(known, "CIE10_CODE", old, "DIAG_ID"))
        dim, mode = known.join(ids, "CIE10_CODE"), "append"
    write_silver(schemas.conform(dim, schemas.DIM_DIAGNOSIS), lake, "dim_diagnosis", mode)
    return sources.read_zone(spark, lake, "silver", "dim_diagnosis")


def link_diagnoses(spark: SparkSession, lake: Lake) -> tuple[DataFrame, DataFrame]:
    """Gold long diagnoses -> silver ``fact_patient_diagnosis`` + rejects."""
    long = sources.read_zone(spark, lake, "gold", "diagnosticos_transformados")
    silver = sources.read_tables(spark, lake, ["dim_patient", "dim_diagnosis"], zone="silver")
    matches = normalize.diagnosis_matches(long, silver["dim_patient"], silver["dim_diagnosis"])
    # Both outputs come from the same joined rows: keep them for the two
    # writes instead of joining twice.
    with session.reused(matches):
        fact, rejects = normalize.split_diagnoses(matches)
        fact = schemas.conform(fact, schemas.FACT_PATIENT_DIAGNOSIS)
        write_silver(fact, lake, "fact_patient_diagnosis")
        sinks.write_zone(rejects, lake, "bronze", "diagnosis_rejects")
    written = sources.read_tables(spark, lake, ["fact_patient_diagnosis"], zone="silver")
    return written["fact_patient_diagnosis"], sources.read_zone(spark, lake, "bronze", "diagnosis_rejects")


def build_gold(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """The three documented gold indicators plus the gap rows."""
    view = sources.read_zone(spark, lake, "gold", "atencion_detalle")
    diag = sources.read_zone(spark, lake, "silver", "fact_patient_diagnosis")
    out = {
        "indicadores_atenciones": gold.attention_counts(view),
        "tiempo_promedio_atencion": gold.mean_gap(view),
        "brechas_atencion": gold.appointment_gaps(view),
        "evolucion_diagnosticos": gold.diagnosis_by_month(diag),
    }
    for name, df in out.items():
        sinks.write_zone(df, lake, "gold", name)
    return out


def quality_report(spark: SparkSession, lake: Lake) -> DataFrame:
    """All silver checks in one table (Q1-Q6)."""
    silver = sources.read_tables(spark, lake, list(schemas.ALL), zone="silver")
    parts = []
    for name, df in silver.items():
        parts.append(quality.summary(
            df, name, not_null=[f.name for f in schemas.ALL[name] if not f.nullable],
            max_length=schemas.MAX_LENGTH.get(name), domains=schemas.DOMAINS.get(name)))
        parts.append(quality.count_summary(
            quality.duplicate_keys(df, schemas.PRIMARY_KEYS[name]), "primary_key", name,
            ",".join(schemas.PRIMARY_KEYS[name])))
    for fact, fk, dim, pk in schemas.FOREIGN_KEYS:
        parts.append(quality.foreign_key_summary(silver[fact], silver[dim], fk, pk, fact, fk))
    return quality.report(parts)


JOBS = ("land_bronze", "build_silver", "bucket_silver", "build_detail", "check_key",
        "transform_diagnoses", "normalize_erp", "load_diagnoses", "link_diagnoses", "build_gold", "quality_report")


def explain(spark: SparkSession, lake: Lake, args: argparse.Namespace) -> None:
    """Print the plan of a job's main output without executing it.

    Building these plans starts no job but for the footers that Spark reads to
    learn a table's schema.
    """
    plans = {
        "build_detail": lambda: detail(
            spark, read_silver(spark, lake, DETAIL_TABLES, args.buckets > 0), args.mode),
        "check_key": lambda: natural_key(
            spark, sources.read_zone(spark, lake, "gold", "atencion_detalle"), args.mode),
        "quality_report": lambda: quality_report(spark, lake),
        "build_gold": lambda: gold.appointment_gaps(
            sources.read_zone(spark, lake, "gold", "atencion_detalle")),
    }
    if args.job not in plans:
        raise SystemExit(f"--explain supports {sorted(plans)}")
    plans[args.job]().explain("formatted")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Health-lake jobs")
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--root", required=True, help="lake root URI")
    parser.add_argument("--env", default="dev")
    parser.add_argument("--mode", choices=["sql", "df"], default="sql")
    parser.add_argument("--workbooks", help="glob of diagnosis workbooks")
    parser.add_argument("--data-address", default="'sheet1'!A1")
    parser.add_argument("--patients", type=int, default=20)
    parser.add_argument("--attentions", type=int, default=40)
    parser.add_argument("--diagnoses", type=int, default=30)
    parser.add_argument("--source-format", help="land_bronze: csv, json, parquet, xlsx, ...")
    parser.add_argument("--source-path", help="land_bronze: files to land")
    parser.add_argument("--name", help="land_bronze, load_diagnoses: bronze table name")
    parser.add_argument("--schema", help="land_bronze: DDL of json or csv lines; what does not fit lands beside them")
    parser.add_argument("--option", action="append", default=[],
                        help="land_bronze: reader option key=value (repeatable)")
    parser.add_argument("--buckets", type=int, default=0,
                        help="bucket_silver: bucket count; build_detail: read bucketed tables")
    parser.add_argument("--literal", action="store_true",
                        help="transform_diagnoses: the melt in its literal steps")
    parser.add_argument("--clean-headers", action="store_true",
                        help="transform_diagnoses: accept month headers in any case and spacing")
    parser.add_argument("--catalog", help="catalog that holds the zones (with --tables)")
    parser.add_argument("--tables", action="store_true",
                        help="read and write catalog tables <env>_<zone>.<name> instead of zone paths")
    parser.add_argument("--snapshots", action="store_true",
                        help="keep each table as published snapshots; silver tables are audited before publication")
    parser.add_argument("--explain", action="store_true",
                        help="print the formatted physical plan of the job's output, do not run it")
    parser.add_argument("--gate", action="store_true",
                        help="quality_report / check_key: fail when a check finds violations")
    args = parser.parse_args(argv)
    required = {"transform_diagnoses": ["workbooks"], "bucket_silver": ["buckets"],
                "land_bronze": ["source_format", "source_path", "name"]}
    missing = [f"--{a.replace('_', '-')}" for a in required.get(args.job, []) if not getattr(args, a)]
    if missing:
        parser.error(f"{args.job} needs {', '.join(missing)}")
    spark = session.get(f"clinilake-{args.job}")
    lake = Lake(args.root, args.env, catalog=args.catalog, tables=args.tables, snapshots=args.snapshots)
    if args.explain:
        explain(spark, lake, args)
        return
    if args.job == "land_bronze":
        options = dict(o.split("=", 1) for o in args.option)
        land_bronze(spark, lake, args.source_format, args.source_path, args.name,
                    args.data_address, args.schema, **options)
    elif args.job == "build_silver":
        build_silver(spark, lake, args.patients, args.attentions, args.diagnoses)
    elif args.job == "bucket_silver":
        bucket_silver(spark, lake, args.buckets)
    elif args.job == "build_detail":
        build_detail(spark, lake, args.mode, bucketed=args.buckets > 0)
    elif args.job == "check_key":
        unique, dups = check_key(spark, lake, args.mode)
        dups.show(truncate=False)
        if args.gate and not unique:
            raise SystemExit("(PACDOC, FECHA_ATENCION) is not a natural key of atencion_detalle")
    elif args.job == "transform_diagnoses":
        transform_diagnoses(spark, lake, args.workbooks, args.data_address, args.literal, args.clean_headers)
    elif args.job == "normalize_erp":
        normalize_erp(spark, lake)
    elif args.job == "load_diagnoses":
        load_diagnoses(spark, lake, args.name or "diagnosis_catalogue")
    elif args.job == "link_diagnoses":
        link_diagnoses(spark, lake)
    elif args.job == "build_gold":
        build_gold(spark, lake)
    else:
        sinks.write_zone(quality_report(spark, lake), lake, "gold", "quality_report")
        if args.gate:
            quality.assert_clean(sources.read_zone(spark, lake, "gold", "quality_report"))


if __name__ == "__main__":
    main()
