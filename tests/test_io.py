import os

import pytest
from pyspark.sql import functions as F

from clinilake import sinks, sources, sql as sqlfiles
from clinilake.lake import Lake
from clinilake.sources.workbooks import parse_address, read_workbook_cells

import xlsx
from conftest import plan_text, rows


def test_lake_paths():
    lake = Lake("s3a://bucket/lake", "prod")
    assert lake.path("silver", "dim_patient") == "s3a://bucket/lake/prod/silver/dim_patient"
    assert lake.table("gold", "x") == "prod_gold.x"
    assert Lake("/x", "test", catalog="lake_test").table("silver", "y") == "lake_test.silver.y"
    with pytest.raises(ValueError):
        lake.path("platinum", "x")
    with pytest.raises(ValueError):
        Lake("/x", "qa")


def test_parquet_round_trip_and_layout(spark, scratch):
    lake = Lake(scratch)
    df = spark.range(100).select(F.col("id"), (F.col("id") % 3).alias("g"))
    sinks.write_table(df, lake.path("silver", "t"), files=2)
    back = sources.read_tables(spark, lake, ["t"])["t"]
    assert rows(back) == rows(df)
    sinks.write_table(df, lake.path("gold", "p"), partition_by=["g"], sort_by=["id"])
    assert sorted(d for d in os.listdir(lake.path("gold", "p")) if d.startswith("g=")) == ["g=0", "g=1", "g=2"]
    sinks.write_table(df.limit(10), lake.path("silver", "t"), mode="append")
    assert spark.read.parquet(lake.path("silver", "t")).count() == 110


def test_save_table_bucketed(spark):
    df = spark.range(50).select(F.col("id"), (F.col("id") % 5).alias("k"))
    sinks.save_table(df, "bucketed_t", bucket_by=(4, ["k"]))
    assert spark.table("bucketed_t").count() == 50
    spark.sql("drop table bucketed_t")


def test_sql_file_and_views(spark, scratch):
    path = os.path.join(scratch, "q.sql")
    with open(path, "w") as fh:
        fh.write("select count(*) as n from t where id > :lo;\n")
    sqlfiles.register({"t": spark.range(10)})
    assert sqlfiles.run_file(spark, path, {"lo": 4}).first()["n"] == 5
    assert "conteo" in sqlfiles.bundled("clave_natural")


def test_land_raw_keeps_values_and_adds_lineage(spark, scratch):
    src = os.path.join(scratch, "json")
    spark.createDataFrame([(1, " Ana "), (2, None)], "id int, name string").write.json(src)
    landed = sources.land_raw(spark, "json", src, schema="id int, name string")
    got = landed.collect()
    assert sorted(r["name"] or "" for r in got) == ["", " Ana "]
    assert all(r["_source_file"].endswith(".json") for r in got)


def test_read_jdbc_requires_bounds(spark):
    with pytest.raises(ValueError):
        sources.read_jdbc(spark, "jdbc:none", "t", partition_column="id")


def test_parse_address():
    assert parse_address("'sheet1'!A1") == ("sheet1", 1, 1)
    assert parse_address("B3") == (None, 3, 2)
    assert parse_address("Hoja 1!AA10") == ("Hoja 1", 10, 27)


def test_workbooks_wide_and_cells(spark, scratch):
    d = os.path.join(scratch, "books")
    os.makedirs(d)
    xlsx.write(os.path.join(d, "a.xlsx"), [
        ["DOCUMENTO", "ENERO 2023", "FEBRERO 2023"],
        [1234567890, "A00", None],
        [987654321, "", "J45"]])
    xlsx.write(os.path.join(d, "b.xlsx"), [
        ["DOCUMENTO", "ENERO 2023", "FEBRERO 2023"],
        [555, "I10", "M54"]], inline=True, start_row=2, start_col=2)
    wide = sources.read_workbooks(spark, os.path.join(d, "a.xlsx"), "'sheet1'!A1")
    assert [f.dataType.typeName() for f in wide.schema][:3] == ["double", "string", "string"]
    assert rows(wide.drop("_source_file")) == [(1234567890.0, "A00", None), (987654321.0, "", "J45")]
    cells = read_workbook_cells(spark, os.path.join(d, "b.xlsx"), "B2")
    assert rows(cells, "row", "header", "text") == [
        (3, "DOCUMENTO", "555"), (3, "ENERO 2023", "I10"), (3, "FEBRERO 2023", "M54")]
    both = sources.read_workbooks(spark, d, "A1",
                                  schema=wide.drop("_source_file").schema)
    # b.xlsx starts at B2, so from A1 it has no matching header row.
    assert both.count() == 2


def test_workbook_booleans_sheet_choice_and_missing_sheet(spark, scratch):
    d = os.path.join(scratch, "books2")
    os.makedirs(d)
    xlsx.write(os.path.join(d, "c.xlsx"), [["DOCUMENTO", "FLAG"], [7, True], [8, False]], sheet="Hoja 1")
    cells = read_workbook_cells(spark, d, "'Hoja 1'!A1")
    assert rows(cells, "row", "header", "text") == [
        (2, "DOCUMENTO", "7"), (2, "FLAG", "TRUE"), (3, "DOCUMENTO", "8"), (3, "FLAG", "FALSE")]
    with pytest.raises(Exception, match="not found"):
        read_workbook_cells(spark, d, "'otra'!A1").collect()


def test_write_table_refuses_to_overwrite_its_input(spark, scratch):
    path = os.path.join(scratch, "t")
    sinks.write_table(spark.range(5), path)
    df = spark.read.parquet(path)
    with pytest.raises(ValueError, match="refusing"):
        sinks.write_table(df.where("id > 1"), path)
    sinks.write_table(df.where("id > 1"), os.path.join(scratch, "t2"))
    sinks.write_table(df.where("id > 1"), path, mode="append")
    assert spark.read.parquet(path).count() == 8


def test_workbook_chunks_keep_rows_whole(spark, scratch):
    from clinilake.sources import workbooks
    path = os.path.join(scratch, "big.xlsx")
    data = [["DOCUMENTO", "ENERO 2023", "FEBRERO 2023"]] + [[i, f"A{i % 7}", None if i % 3 else "J45"]
                                                           for i in range(1, 1001)]
    xlsx.write(path, data)
    with open(path, "rb") as fh:
        content = fh.read()
    chunks = list(workbooks._cell_chunks(path, content, None, 1, 1, chunk_rows=64))
    assert len(chunks) == 16 and all(c["row"].nunique() <= 64 for c in chunks)
    seen = [set(c["row"]) for c in chunks]
    assert all(not (a & b) for a, b in zip(seen, seen[1:]))
    wide = sources.read_workbooks(spark, path, "A1")
    assert wide.count() == 1000
    assert wide.where(F.col("FEBRERO 2023") == "J45").count() == 333


def test_jdbc_paths_reach_the_jdbc_source(spark):
    # No database is started: a URL that no driver accepts shows that the
    # options reach Spark's JDBC source, which then refuses to connect.
    with pytest.raises(Exception, match="(?i)suitable driver"):
        sources.read_jdbc(spark, "jdbc:clinilake-none:x", "t", partition_column="id",
                          lower_bound=0, upper_bound=10, num_partitions=2)
    with pytest.raises(Exception, match="(?i)suitable driver"):
        sinks.write_jdbc(spark.range(3), "jdbc:clinilake-none:x", "t", num_partitions=1)


def test_partitioned_write_splits_a_hot_directory(spark, scratch):
    # 90% of rows share one directory value; with the rebalance hint AQE
    # spreads it over several tasks, so it lands in several files.
    hot = spark.range(200000).select(F.col("id"), F.when(F.col("id") % 10 == 0, F.col("id") % 3)
                                     .otherwise(F.lit(99)).alias("g"))
    path = os.path.join(scratch, "hot")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        plan_df = sinks._layout(hot, None, ["g"], None)
        assert "RebalancePartitions" in plan_text(plan_df, "analyzed")
        sinks.write_table(hot, path, partition_by=["g"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = [f for f in os.listdir(os.path.join(path, "g=99")) if f.endswith(".parquet")]
    assert len(files) > 1
    assert spark.read.parquet(path).count() == 200000


def test_workbook_without_cell_references(spark, scratch):
    import zipfile
    from clinilake.sources.workbooks import iter_cells
    path = os.path.join(scratch, "noref.xlsx")
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rns = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    sheet = (f'<worksheet {ns}><sheetData>'
             '<row><c t="inlineStr"><is><t>DOCUMENTO</t></is></c><c t="inlineStr"><is><t>ENERO 2023</t></is></c></row>'
             '<row><c><v>7</v></c><c t="inlineStr"><is><t>A00</t></is></c></row>'
             '<row r="5"><c r="B5" t="inlineStr"><is><t>J45</t></is></c></row>'
             '</sheetData></worksheet>')
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} {rns}><sheets><sheet name="s" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   '<Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", sheet)
    with open(path, "rb") as fh:
        cells = list(iter_cells(fh.read()))
    assert cells == [(1, 1, "DOCUMENTO", None), (1, 2, "ENERO 2023", None), (2, 1, "7", 7.0),
                     (2, 2, "A00", None), (5, 2, "J45", None)]
    wide = sources.read_workbooks(spark, path)
    assert rows(wide.drop("_source_file")) == [(7.0, "A00"), (None, "J45")]


def test_ensure_database_with_awkward_root(spark, scratch):
    root = os.path.join(scratch, "it's lake")
    lake = Lake(root, "test")
    db = lake.ensure_database(spark, "gold")
    assert db == "test_gold"
    assert any(r.namespace == "test_gold" for r in spark.sql("show databases").collect())


def test_read_table_with_declared_schema(spark, scratch):
    path = os.path.join(scratch, "declared")
    spark.range(3).withColumnRenamed("id", "k").write.parquet(path)
    df = sources.read_table(spark, path, "k long, extra string")
    assert rows(df) == [(0, None), (1, None), (2, None)]


def test_workbook_columns_are_never_lost(spark, scratch):
    d = os.path.join(scratch, "books3")
    os.makedirs(d)
    xlsx.write(os.path.join(d, "a.XLSX"), [["DOCUMENTO", "ENERO 2023", "ENERO 2023", None, "VACIA"],
                                           [1, "A00", "J45", "LOST", None]])
    wide = sources.read_workbooks(spark, d)
    assert wide.columns == ["DOCUMENTO", "ENERO 2023", "ENERO 2023_2", "_col4", "VACIA", "_source_file"]
    assert rows(wide.drop("_source_file")) == [(1.0, "A00", "J45", "LOST", None)]
    assert read_workbook_cells(spark, d).count() == 4


def test_workbook_with_headers_only(spark, scratch):
    path = os.path.join(scratch, "empty.xlsx")
    xlsx.write(path, [["DOCUMENTO", "ENERO 2023"]])
    wide = sources.read_workbooks(spark, path)
    assert wide.columns == ["DOCUMENTO", "ENERO 2023", "_source_file"] and wide.count() == 0
    assert read_workbook_cells(spark, path).count() == 0


def test_a_rewritten_table_shows_its_new_columns(spark, scratch):
    from clinilake.plans import catalog
    path = f"{scratch}/t.parquet"
    spark.range(3).select(F.col("id").alias("a")).write.parquet(path)
    assert catalog.table(spark, scratch, "t").columns == ["a"]
    spark.range(3).select(F.col("id").alias("a"), F.lit(1).alias("b")).write.mode("overwrite").parquet(path)
    assert catalog.table(spark, scratch, "t").columns == ["a", "b"]


def test_workbook_dates_and_booleans(spark, scratch):
    import datetime as dt
    from clinilake.sources.workbooks import serial_text
    path = os.path.join(scratch, "kinds.xlsx")
    xlsx.write(path, [["N", "DAY", "FLAG", "MIXED"], [1, dt.datetime(2024, 2, 29, 13, 30), True, dt.datetime(2020, 1, 1)],
                      [2.5, None, False, "text"], [3, dt.datetime(1999, 12, 31), None, 7]])
    wide = sources.read_workbooks(spark, path).drop("_source_file")
    assert [f.dataType.typeName() for f in wide.schema] == ["double", "timestamp", "boolean", "string"]
    assert rows(wide) == [
        (1.0, dt.datetime(2024, 2, 29, 13, 30), True, "2020-01-01 00:00:00"), (2.5, None, False, "text"),
        (3.0, dt.datetime(1999, 12, 31), None, "7")]
    assert serial_text(1) == "1900-01-01 00:00:00" and serial_text(61) == "1900-03-01 00:00:00"
    assert serial_text(0, True) == "1904-01-01 00:00:00" and serial_text(1e12) is None
