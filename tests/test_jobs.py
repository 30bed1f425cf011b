import datetime as dt
import os

import pytest

from pyspark.sql import functions as F

from clinilake import schemas
from clinilake.lake import Lake
from clinilake.plans import jobs

import xlsx
from conftest import plan_text, rows


def test_health_lake_end_to_end(spark, scratch):
    lake = Lake(scratch)
    jobs.build_silver(spark, lake, n_patients=40, n_attentions=200, n_diagnoses=60, seed=5)
    view = jobs.build_detail(spark, lake, mode="sql")
    df_form = jobs.detail(spark, {n: spark.read.parquet(lake.path("silver", n)) for n in jobs.DETAIL_TABLES}, "df")
    gold_view = spark.read.parquet(lake.path("gold", "atencion_detalle"))
    assert gold_view.count() == 200
    assert gold_view.exceptAll(df_form).count() == 0 and df_form.exceptAll(gold_view).count() == 0
    unique_sql, dups_sql = jobs.check_key(spark, lake, "sql")
    unique_df, dups_df = jobs.check_key(spark, lake, "df")
    assert unique_sql == unique_df and rows(dups_sql) == rows(dups_df)
    out = jobs.build_gold(spark, lake)
    assert spark.read.parquet(lake.path("gold", "indicadores_atenciones")) \
        .agg(F.sum("attentions")).first()[0] == 200
    gaps = spark.read.parquet(lake.path("gold", "brechas_atencion")).count()
    assert gaps == 200 - view.select("PACDOC").distinct().count()
    report = jobs.quality_report(spark, lake)
    assert report.where(F.col("violations") > 0).count() == 0
    assert report.count() > 20
    assert set(out) == {"indicadores_atenciones", "tiempo_promedio_atencion", "brechas_atencion",
                        "evolucion_diagnosticos"}


def test_quality_report_finds_planted_faults(spark, scratch):
    lake = Lake(scratch)
    tables = jobs.build_silver(spark, lake, n_patients=10, n_attentions=20, n_diagnoses=5)
    bad = tables["fact_attention"].withColumn(
        "PACID", F.when(F.col("ATTID") == 1, F.lit(999)).otherwise(F.col("PACID")))
    bad.write.mode("overwrite").parquet(lake.path("silver", "fact_attention_tmp"))
    spark.read.parquet(lake.path("silver", "fact_attention_tmp")).write.mode("overwrite") \
        .parquet(lake.path("silver", "fact_attention"))
    report = {(r["check_name"], r["table_name"], r["column_name"]): r["violations"]
              for r in jobs.quality_report(spark, lake).collect()}
    assert report[("foreign_key", "fact_attention", "PACID")] == 1


def test_diagnoses_workbook_to_silver(spark, scratch):
    lake = Lake(scratch)
    jobs.build_silver(spark, lake, n_patients=5, n_attentions=5, n_diagnoses=5)
    docs = [r["PACDOC"] for r in spark.read.parquet(lake.path("silver", "dim_patient")).orderBy("PACID").collect()]
    book = os.path.join(scratch, "in", "fichas.xlsx")
    os.makedirs(os.path.dirname(book))
    xlsx.write(book, [["DOCUMENTO", "ENERO 2023", "FEBRERO 2023", "MARZO 2023"],
                      [float(docs[0]), "A00", "Asma", None],
                      [float(docs[1]), "", "Gripe", "J45"],
                      [123.0, "I10", None, None]])
    long = jobs.transform_diagnoses(spark, lake, os.path.join(scratch, "in"))
    literal = jobs.diagnoses_long(jobs.sources.read_workbooks(
        spark, os.path.join(scratch, "in"), "'sheet1'!A1").drop("_source_file"))
    assert rows(long) == rows(literal)
    assert long.count() == 5
    fact, rejects = jobs.link_diagnoses(spark, lake)
    assert fact.count() == 3 and rejects.count() == 2
    assert rows(fact, "DIAG_ID", "DATE") == [(1, dt.date(2023, 1, 1)), (8, dt.date(2023, 2, 1)),
                                             (8, dt.date(2023, 3, 1))]


def test_normalize_erp_job(spark, scratch):
    lake = Lake(scratch)
    spark.createDataFrame([(1, "10", "ana maria gomez", "Cali", dt.datetime(2024, 1, 1))],
                          schemas.BRONZE_PATIENT).write.parquet(lake.path("bronze", "patient"))
    spark.createDataFrame([(1, dt.datetime(2024, 1, 1), "Asignado", "Sí", 1, 1)],
                          schemas.BRONZE_ATTENTION).write.parquet(lake.path("bronze", "attention"))
    spark.createDataFrame([(1, "Pediatría", "Clínica")],
                          schemas.BRONZE_SPECIALITY).write.parquet(lake.path("bronze", "speciality"))
    jobs.normalize_erp(spark, lake)
    pat = spark.read.parquet(lake.path("silver", "dim_patient")).first()
    assert (pat["FIRST_NAME"], pat["SECOND_NAME"], pat["LAST_NAME"]) == ("ANA", "MARIA", "GOMEZ")
    view = jobs.build_detail(spark, lake, "df").first()
    assert (view["SPENAME"], view["SPEGRP_NAME"], view["ASISTENCIA"]) == ("PEDIATRIA", "CLINICA", "SI")


def test_quality_gate_cli(spark, scratch):
    import pytest
    from clinilake.operators.quality import QualityError
    jobs.main(["build_silver", "--root", scratch, "--patients", "5", "--attentions", "9"])
    jobs.main(["quality_report", "--root", scratch, "--gate"])
    bad = spark.read.parquet(f"{scratch}/dev/silver/dim_patient").limit(0)
    bad.write.mode("overwrite").parquet(f"{scratch}/dev/silver/dim_patient_empty")
    spark.read.parquet(f"{scratch}/dev/silver/dim_patient_empty").write.mode("overwrite") \
        .parquet(f"{scratch}/dev/silver/dim_patient")
    with pytest.raises(QualityError, match="foreign_key"):
        jobs.main(["quality_report", "--root", scratch, "--gate"])


def test_land_bronze_job(spark, scratch):
    src = os.path.join(scratch, "src")
    spark.createDataFrame([(1, "ana maria gomez")], "PACID int, PACNAME string").write.json(src)
    jobs.main(["land_bronze", "--root", scratch, "--source-format", "json", "--source-path", src,
               "--name", "patient_raw"])
    landed = spark.read.parquet(f"{scratch}/dev/bronze/patient_raw")
    assert landed.count() == 1 and {"_source_file", "_ingested_at", "PACNAME"} <= set(landed.columns)
    books = os.path.join(scratch, "books")
    os.makedirs(books)
    xlsx.write(os.path.join(books, "d.xlsx"), [["DOCUMENTO", "ENERO 2023"], [5, "A00"]])
    jobs.main(["land_bronze", "--root", scratch, "--source-format", "xlsx", "--source-path", books,
               "--name", "diagnosticos"])
    cells = spark.read.parquet(f"{scratch}/dev/bronze/diagnosticos")
    assert rows(cells, "header", "text") == [("DOCUMENTO", "5"), ("ENERO 2023", "A00")]


def test_bucketed_silver_joins_without_shuffle(spark, scratch):
    lake = Lake(scratch, "test")
    jobs.build_silver(spark, lake, n_patients=300, n_attentions=3000, n_diagnoses=10, seed=9)
    jobs.bucket_silver(spark, lake, buckets=4)
    plain = jobs.detail(spark, jobs.read_silver(spark, lake, jobs.DETAIL_TABLES), "df")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        silver = jobs.read_silver(spark, lake, jobs.DETAIL_TABLES, bucketed=True)
        fact_patient = silver["fact_attention"].alias("f").join(
            silver["dim_patient"].alias("p"), F.col("f.PACID") == F.col("p.PACID"))
        plan = plan_text(fact_patient)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        bucketed = jobs.detail(spark, silver, "df")
        assert rows(bucketed) == rows(plain)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_explain_prints_plan_without_writing(spark, scratch, capsys):
    jobs.main(["build_silver", "--root", scratch, "--patients", "5", "--attentions", "9"])
    jobs.main(["build_detail", "--root", scratch, "--mode", "sql", "--explain"])
    assert not os.path.exists(f"{scratch}/dev/gold/atencion_detalle")


def test_lake_flow_through_the_cli(spark, scratch):
    raw = os.path.join(scratch, "raw")
    spark.createDataFrame([(1, "10", "ana maria gomez", "Bogotá", dt.datetime(2024, 1, 1)),
                           (2, "20", "luis perez", "Cali", dt.datetime(2024, 2, 1))],
                          schemas.BRONZE_PATIENT).write.json(os.path.join(raw, "patient"))
    spark.createDataFrame([(1, dt.datetime(2024, 3, 1, 8), "Asignado", "Sí", 1, 1),
                           (2, dt.datetime(2024, 3, 9, 8), "Asignado", "No", 1, 2),
                           (3, dt.datetime(2024, 4, 1, 9), "Cancelado", "No", 2, 1)],
                          schemas.BRONZE_ATTENTION).write.json(os.path.join(raw, "attention"))
    spark.createDataFrame([(1, "Pediatría", "Clínica"), (2, "Cirugía General", "Quirúrgica")],
                          schemas.BRONZE_SPECIALITY).write.json(os.path.join(raw, "speciality"))
    books = os.path.join(raw, "books")
    os.makedirs(books)
    xlsx.write(os.path.join(books, "fichas.xlsx"), [["DOCUMENTO", "ENERO 2024", "FEBRERO 2024"],
                                                    [10.0, "J45", "Asma"], [30.0, "I10", None]])
    base = ["--root", scratch]
    ddl = {"patient": schemas.BRONZE_PATIENT, "attention": schemas.BRONZE_ATTENTION,
           "speciality": schemas.BRONZE_SPECIALITY}
    for name in ddl:
        jobs.main(["land_bronze", *base, "--source-format", "json", "--name", name,
                   "--source-path", os.path.join(raw, name)])
    # Landed JSON keeps text types; the normalisation casts them.
    jobs.main(["normalize_erp", *base])
    from clinilake.operators import synth
    synth.diagnoses(spark).write.mode("overwrite").parquet(f"{scratch}/dev/silver/dim_diagnosis")
    jobs.main(["build_detail", *base, "--mode", "sql"])
    jobs.main(["check_key", *base])
    jobs.main(["transform_diagnoses", *base, "--workbooks", books])
    jobs.main(["link_diagnoses", *base])
    jobs.main(["build_gold", *base])
    detail = spark.read.parquet(f"{scratch}/dev/gold/atencion_detalle")
    assert detail.count() == 3
    assert rows(detail, "ATTID", "SPEGRP_NAME", "ASISTENCIA") == [
        (1, "CLINICA", "SI"), (2, "QUIRURGICA", "NO"), (3, "CLINICA", "NO")]
    gaps = spark.read.parquet(f"{scratch}/dev/gold/brechas_atencion")
    assert rows(gaps, "PACDOC", "gap_days") == [("10", 8)]
    facts = spark.read.parquet(f"{scratch}/dev/silver/fact_patient_diagnosis")
    assert rows(facts, "PACID", "DIAG_ID", "DATE") == [(1, 8, dt.date(2024, 1, 1)), (1, 8, dt.date(2024, 2, 1))]
    assert spark.read.parquet(f"{scratch}/dev/bronze/diagnosis_rejects").count() == 1


def test_cli_reports_missing_arguments(scratch, capsys):
    import pytest
    with pytest.raises(SystemExit):
        jobs.main(["transform_diagnoses", "--root", scratch])
    assert "--workbooks" in capsys.readouterr().err
    with pytest.raises(SystemExit):
        jobs.main(["land_bronze", "--root", scratch, "--name", "x"])
    assert "--source-format, --source-path" in capsys.readouterr().err


def test_lake_jobs_on_catalog_tables(spark, scratch):
    lake = Lake(scratch, "test", tables=True)
    jobs.build_silver(spark, lake, n_patients=30, n_attentions=120, n_diagnoses=20, seed=2)
    jobs.build_detail(spark, lake, "sql")
    unique, _ = jobs.check_key(spark, lake, "df")
    report = jobs.quality_report(spark, lake)
    assert spark.table("test_gold.atencion_detalle").count() == 120
    assert unique in (True, False)
    assert report.where("violations > 0").count() == 0
    assert not os.path.exists(f"{scratch}/test/gold/atencion_detalle")  # tables, not zone paths
    with pytest.raises(Exception):  # Spark refuses to overwrite a table the plan reads
        from clinilake import sinks
        sinks.write_zone(spark.table("test_gold.atencion_detalle").limit(5), lake, "gold", "atencion_detalle")


def test_check_key_gate(spark, scratch):
    lake = Lake(scratch)
    jobs.build_silver(spark, lake, n_patients=5, n_attentions=20)
    jobs.build_detail(spark, lake, "df")
    jobs.main(["check_key", "--root", scratch, "--gate"])  # generated times do not repeat
    view = spark.read.parquet(f"{scratch}/dev/gold/atencion_detalle")
    doubled = view.unionByName(view.limit(1))
    doubled.write.mode("overwrite").parquet(f"{scratch}/dev/gold/atencion_detalle_tmp")
    spark.read.parquet(f"{scratch}/dev/gold/atencion_detalle_tmp").write.mode("overwrite") \
        .parquet(f"{scratch}/dev/gold/atencion_detalle")
    with pytest.raises(SystemExit, match="not a natural key"):
        jobs.main(["check_key", "--root", scratch, "--gate"])
