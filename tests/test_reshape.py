import datetime as dt

import pytest
from pyspark.sql import functions as F

from clinilake.operators.reshape import (diagnoses_long, drop_blank, unpivot_months,
                                         unpivot_to_dates)

from conftest import plan_text, rows


def _sheet(spark):
    return spark.createDataFrame(
        [(1234567890.0, "A00", "", "J45", " "), (12.5, None, "A00", "A00", "I10"),
         (None, "M54", None, None, None)],
        "DOCUMENTO double, `ENERO 2023` string, `FEBRERO 2023` string, `MARZO  2023` string, "
        "`FOO'S 2023` string")


def test_unpivot_rows_times_columns(spark):
    sheet = _sheet(spark)
    long = unpivot_months(sheet, "DOCUMENTO")
    assert long.count() == 3 * 4
    assert long.columns == ["DOCUMENTO", "MES_ANO", "DIAGNOSTICO"]
    assert "FOO'S 2023" in {r[0] for r in long.select("MES_ANO").collect()}


def test_literal_and_header_once_forms_agree(spark):
    sheet = _sheet(spark)
    a, b = diagnoses_long(sheet), unpivot_to_dates(sheet)
    assert a.schema.names == b.schema.names == ["DOCUMENTO", "FECHA", "DIAGNOSTICO"]
    assert rows(a) == rows(b)
    assert rows(a) == sorted([
        ("1234567890", dt.date(2023, 1, 1), "A00"), ("1234567890", dt.date(2023, 3, 1), "J45"),
        ("1234567890", None, " "), ("13", dt.date(2023, 2, 1), "A00"),
        ("13", dt.date(2023, 3, 1), "A00"), ("13", None, "I10"), (None, dt.date(2023, 1, 1), "M54")],
        key=repr)


def test_mixed_value_types_are_cast(spark):
    df = spark.createDataFrame([("d1", 1, "x")], "DOCUMENTO string, `ENERO 2024` int, `FEBRERO 2024` string")
    out = unpivot_to_dates(df, id_expr=F.col("DOCUMENTO"))
    assert rows(out) == [("d1", dt.date(2024, 1, 1), "1"), ("d1", dt.date(2024, 2, 1), "x")]


def test_no_value_columns(spark):
    df = spark.createDataFrame([("1",)], "DOCUMENTO string")
    with pytest.raises(ValueError):
        unpivot_months(df)
    with pytest.raises(ValueError):
        unpivot_to_dates(df)


def test_drop_blank(spark):
    df = spark.createDataFrame([("a",), ("",), (" ",), (None,)], "v string")
    assert drop_blank(df, "v").count() == 2
    assert drop_blank(df, "v", trim=True).count() == 1


def test_unpivot_is_narrow(spark):
    plan = plan_text(unpivot_to_dates(_sheet(spark)))
    assert "Exchange" not in plan


def test_unpivot_clean_headers(spark):
    df = spark.createDataFrame([("d1", "A00", "J45")], "DOCUMENTO string, ` enero 2023` string, `FEBRERO 2023` string")
    strict = rows(unpivot_to_dates(df, id_expr=F.col("DOCUMENTO")))
    clean = rows(unpivot_to_dates(df, id_expr=F.col("DOCUMENTO"), clean_headers=True))
    assert strict == [("d1", None, "A00"), ("d1", None, "J45")]
    assert clean == [("d1", dt.date(2023, 1, 1), "A00"), ("d1", dt.date(2023, 2, 1), "J45")]
    assert rows(diagnoses_long(df.withColumnRenamed("DOCUMENTO", "DOCUMENTO"), clean_headers=True), "FECHA") == \
        [(dt.date(2023, 1, 1),), (dt.date(2023, 2, 1),)]


def test_unpivot_equals_stack_generator(spark):
    sheet = _sheet(spark).drop("FOO'S 2023")
    cols = [c for c in sheet.columns if c != "DOCUMENTO"]
    stack = f"stack({len(cols)}, " + ", ".join(f"'{c}', `{c}`" for c in cols) + ") as (MES_ANO, DIAGNOSTICO)"
    via_stack = sheet.selectExpr("DOCUMENTO", stack)
    assert rows(unpivot_months(sheet, "DOCUMENTO")) == rows(via_stack)


def test_headers_with_dots_backticks_and_quotes(spark):
    df = spark.createDataFrame([("1", "A00", "J45", "I10")], ["DOCUMENTO", "ENE. 2023", "EN`ERO 2023", "E'N\"E 2023"])
    assert {tuple(r) for r in unpivot_months(df).collect()} == {
        ("1", "E'N\"E 2023", "I10"), ("1", "EN`ERO 2023", "J45"), ("1", "ENE. 2023", "A00")}
    assert rows(unpivot_to_dates(df), "DIAGNOSTICO") == [("A00",), ("I10",), ("J45",)]
    dotted = spark.createDataFrame([("1", "A00")], ["DOC.UMENTO", "ENERO 2023"])
    assert rows(unpivot_to_dates(dotted, "DOC.UMENTO")) == [("1", dt.date(2023, 1, 1), "A00")]
    assert rows(diagnoses_long(dotted, "DOC.UMENTO")) == [("1", dt.date(2023, 1, 1), "A00")]
