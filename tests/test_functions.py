import datetime as dt

from pyspark.sql import functions as F

from clinilake.functions import (SPANISH_MONTHS, document_text, month_label, month_labels,
                                 month_text_to_date, normalize_text)
from conftest import plan_text


def test_normalize_text_edges(spark):
    df = spark.createDataFrame([(" Pediatría ",), ("\tSí ",), ("Ñandú ß æ",), ("",), (None,),
                                ("cirugía  general",)], "t string")
    out = [r[0] for r in df.select(normalize_text("t")).collect()]
    assert out == ["PEDIATRIA", "SI", "NANDU SS AE", "", None, "CIRUGIA  GENERAL"]


def test_normalize_text_matches_python_rule(spark):
    import unicodedata
    words = ["Medicina Interna", "Ginecología", "Radiología", "Hipertensión esencial",
             "Reflujo gastroesofágico", "Cólera", "Úlcera", "Ünïcödé"]
    expect = ["".join(c for c in unicodedata.normalize("NFD", w.strip().upper())
                      if unicodedata.category(c) != "Mn") for w in words]
    df = spark.createDataFrame([(w,) for w in words], "t string")
    assert [r[0] for r in df.select(normalize_text("t")).collect()] == expect


def test_document_text(spark):
    df = spark.createDataFrame([(1234567890.0, "1234567890"), (12.5, "12.5"), (None, None),
                                (None, "AB1"), (None, "1" * 21)], "d double, s string")
    out = df.select(document_text("d").alias("a"), document_text("s").alias("b")).collect()
    assert [r["a"] for r in out] == ["1234567890", "13", None, None, None]
    assert [r["b"] for r in out] == ["1234567890", "13", None, None, None]


def test_document_text_from_exponent_double(spark):
    df = spark.createDataFrame([(1.23456789e9,)], "d double")
    assert df.select(document_text("d")).first()[0] == "1234567890"


def test_month_text_to_date_edges(spark):
    texts = ["ENERO 2023", "ENERO  2023", "ENERO", " ENERO 2023", "enero 2023", "FOO 2023",
             "ENERO 23", "ENERO 20X3", "ENERO 2023", None, "DICIEMBRE 1999"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = [r[0] for r in df.select(month_text_to_date("t")).collect()]
    assert out == [dt.date(2023, 1, 1), dt.date(2023, 1, 1), None, None, None, None, None, None,
                   None, None, dt.date(1999, 12, 1)]


def test_all_twelve_months_round_trip(spark):
    labels = month_labels(2023, 2023)
    assert labels[0] == "ENERO 2023" and labels[-1] == "DICIEMBRE 2023" and len(labels) == 12
    df = spark.createDataFrame([(t,) for t in labels], "t string")
    dates = [r[0] for r in df.select(month_text_to_date("t")).collect()]
    assert dates == [dt.date(2023, m, 1) for m in range(1, 13)]
    back = df.select(month_label(month_text_to_date("t"))).collect()
    assert [r[0] for r in back] == labels
    assert len(SPANISH_MONTHS) == 12


def test_month_parse_of_literal_is_folded(spark):
    df = spark.range(1).select(month_text_to_date(F.lit("MARZO 2024")).alias("d"))
    plan = plan_text(df, "optimized")
    assert "Project [2024-03-01 AS d" in plan and "split(" not in plan.lower()


def test_clean_headers_option(spark):
    texts = [" enero 2023", "ENERO 2023", "Febrero  2024 ", "enero 23", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    strict = [r[0] for r in df.select(month_text_to_date("t")).collect()]
    clean = [r[0] for r in df.select(month_text_to_date("t", clean=True)).collect()]
    assert strict == [None, None, None, None, None]
    assert clean == [dt.date(2023, 1, 1), dt.date(2023, 1, 1), dt.date(2024, 2, 1), None, None]


def test_other_month_names(spark):
    english = ["JANUARY", "FEBRUARY", "MARCH", "APRIL", "MAY", "JUNE", "JULY", "AUGUST",
               "SEPTEMBER", "OCTOBER", "NOVEMBER", "DECEMBER"]
    df = spark.createDataFrame([("MARCH 2024",), ("MARZO 2024",)], "t string")
    out = [r[0] for r in df.select(month_text_to_date("t", months=english)).collect()]
    assert out == [dt.date(2024, 3, 1), None]
    assert df.select(month_label(F.lit(dt.date(2024, 3, 9)), english)).first()[0] == "MARCH 2024"
    import pytest
    with pytest.raises(ValueError):
        month_text_to_date("t", months=english[:11])


def test_normalize_strips_tab_and_nbsp(spark):
    df = spark.createDataFrame([("\tSí ",), ("  Cólera\t",)], "t string")
    assert [r[0] for r in df.select(normalize_text("t")).collect()] == ["SI", "COLERA"]


def test_normalize_decomposed_extended_and_ordinals(spark):
    df = spark.createDataFrame([("PEDIATRI\u0301A",), ("1\u00ba 2\u00aa",), ("\u1ea4\u01d7\u0219",), ("stra\u00dfe",)], "t string")
    assert [r[0] for r in df.select(normalize_text("t")).collect()] == ["PEDIATRIA", "1o 2a", "AUS", "STRASSE"]


def test_normalize_text_spells_greek_and_cyrillic(spark):
    given = {" Жуковский ": "ZhUKOVSKII", "щука, ёж": "ShchUKA, IoZh", "Київ": "KIYiV", "Ψυχή Θεός": "PsUKhE ThEOS",
             "άξιος ς": "AXIOS S", "Mixed Ю 北京": "MIXED Iu 北京", "é й": "E I", "Й": "I", "": "", "abc": "ABC"}
    df = spark.createDataFrame([(t,) for t in given], "t string")
    assert {r.t: r[1] for r in df.select("t", normalize_text("t")).collect()} == given


def test_normalize_text_spells_every_letter_of_the_tables(spark):
    import unicodedata

    from clinilake import functions as f
    named = f._GREEK | f._CYRILLIC
    base = {chr(c): unicodedata.normalize("NFD", chr(c))[0] for block in f._OTHER for c in block if chr(c) == chr(c).upper()}
    given = {c: named[b] for c, b in base.items() if b in named} | named
    df = spark.createDataFrame([(c, f"x{c}\u0301{c} \u00b5") for c in given], "c string, t string")
    assert {r.c: r[1] for r in df.select("c", normalize_text("t")).collect()} == {c: f"X{t}{t} M" for c, t in given.items()}
    # without a letter of another script, the micro sign keeps its Greek capital
    assert spark.createDataFrame([("\u00b5 \u00e6\u0133",)], "t string").select(normalize_text("t")).first()[0] == "\u039c AEIJ"


def test_normalize_text_never_cuts_texts_into_letters(spark):
    """Each letter was an array item, looked up in a map, after a copy of the whole text."""
    plan = plan_text(spark.createDataFrame([("\u0436",)], "t string").select(normalize_text("t")), "optimized")
    assert "regexp_extract_all" not in plan and "str_to_map" not in plan and "transform" not in plan
    long = "\u0436 \u00e9\u043b " * 50_000
    got = spark.createDataFrame([(long,)], "t string").select(normalize_text("t")).first()[0]
    assert got == ("Zh EL " * 50_000).rstrip()
