"""The operators run on the provided TPC-H-like tables.

Each query reads whole tables from ``sf_dir`` and returns a lazy DataFrame;
:data:`ORACLE` holds an equivalent DuckDB statement for the same columns.
Role mapping to the health model: ``lineitem`` = appointments, ``part`` =
patient, ``supplier`` = speciality, ``nation`` = speciality group, ``orders``
and ``customer`` = appointments per patient, ``documents``/``labels`` = a
foreign-key pair, ``events`` = timestamps to turn into month text.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinilake import schemas, sinks, snapshots
from clinilake import sql as sqlfiles
from clinilake.functions import (SPANISH_MONTHS, document_text, month_label, month_labels,
                                 month_text_to_date, normalize_text)
from clinilake.lake import Lake
from clinilake.names import col
from clinilake.operators import gold, increment, ledger, normalize, quality
from clinilake.operators.joins import Dim, star_join
from clinilake.operators.normalize import (diagnosis_matches, extract_dimension,
                                           numbered_diagnoses, split_person_name)
from clinilake.operators.normalize import diagnosis_rejects as rejected_diagnoses
from clinilake.operators.reshape import diagnoses_long, unpivot_months, unpivot_to_dates
from clinilake.plans import jobs
from clinilake.plans.jobs import detail_df, detail_sql
from clinilake.session import checkpoint_dir
from clinilake.sources import literal_table, parse_lines, read_tables, read_zone, rebuilt

Query = Callable[[SparkSession, str], DataFrame]

# Decoding of the two coded lineitem flags (the status
# catalogues of the star join).
RETURN_STATUS = [("A", "ACCEPTED"), ("N", "NONE"), ("R", "RETURNED")]
LINE_STATUS = [("F", "FULFILLED"), ("O", "OPEN")]
ORDER_STATUS_DOMAIN = ["F", "O"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
MARKET_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
# A diagnosis-like catalogue over order priorities.  "2-HIGH"
# is found through its description, "5-LOW" is missing on purpose.
PRIORITY_CATALOGUE = [(1, "1-URGENT", "URGENTE"), (2, "P2", "2-high"), (3, "3-MEDIUM", "MEDIO"),
                      (4, "4-NOT SPECIFIED", "SIN ESPECIFICAR")]

# Greek and Cyrillic letters and their spelling in capitals.
PLANTED_LETTERS = {"α": "A", "ή": "E", "θ": "Th", "ξ": "X", "ς": "S", "ψ": "Ps", "ώ": "O", "ж": "Zh", "й": "I",
                   "щ": "Shch", "ы": "Y", "ю": "Iu", "ё": "Io", "є": "Ie", "ї": "Yi", "љ": "Lj"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One provided table, as any other parquet table of the library is read."""
    return read_tables(spark, sf_dir, [name], suffix=".parquet")[name]


def _status(spark: SparkSession, rows: list[tuple[str, str]], code: str, desc: str) -> DataFrame:
    return literal_table(spark, rows, f"{code} string, {desc} string")


# --- J1: star join -------------------------------------------------------
# No dimension is forced to broadcast: Spark compares each one's size (file
# sizes for parquet, exact size for the literal catalogues) with
# spark.sql.autoBroadcastJoinThreshold, so nation and the catalogues are
# broadcast at any scale while part and supplier become sort-merge joins once
# they outgrow the threshold.

def star_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = [
        Dim(table(spark, sf_dir, "part"), "p", [("l_partkey", "p_partkey")]),
        Dim(table(spark, sf_dir, "supplier"), "s", [("l_suppkey", "s_suppkey")]),
        Dim(table(spark, sf_dir, "nation"), "n", [("s_nationkey", "n_nationkey")], parent="s"),
        Dim(_status(spark, RETURN_STATUS, "rf_code", "rf_desc"), "rs", [("l_returnflag", "rf_code")]),
        Dim(_status(spark, LINE_STATUS, "ls_code", "ls_desc"), "ls", [("l_linestatus", "ls_code")]),
    ]
    return star_join(table(spark, sf_dir, "lineitem"), dims, [
        "f.l_orderkey", "f.l_linenumber", F.col("f.l_shipdate").alias("ship_date"),
        "p.p_partkey", "p.p_name", "p.p_brand", "p.p_type", "s.s_suppkey", "s.s_name",
        F.col("n.n_name").alias("supplier_nation"), F.col("rs.rf_desc").alias("return_status"),
        F.col("ls.ls_desc").alias("line_status"), "f.l_quantity"])


def star_detail_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    sqlfiles.register({n: table(spark, sf_dir, n) for n in ("lineitem", "part", "supplier", "nation")})
    return sqlfiles.run_bundled(spark, "star_detail")


# --- A1-A3: natural key ----------------------------------------------------

def detail_natural_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 on the star-join view, as the design runs it on its gold view."""
    return quality.duplicate_keys(star_detail(spark, sf_dir), ["p_partkey", "ship_date"])


def detail_mean_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 on the star-join view: mean days between shipments of each part."""
    return gold.mean_gap(star_detail(spark, sf_dir), "p_partkey", "ship_date")


def detail_attention_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 on the star-join view: lines per supplier ("speciality") and part."""
    return gold.attention_counts(star_detail(spark, sf_dir), ["s_name", "p_partkey"])


def natural_key_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_shipdate"])


def natural_key_dups_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    sqlfiles.register({"lineitem": table(spark, sf_dir, "lineitem")})
    return sqlfiles.run_bundled(spark, "natural_key_dups")


def key_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report([
        quality.key_verdict(table(spark, sf_dir, "orders"), ["o_orderkey"], "orders"),
        quality.key_verdict(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "lineitem"),
    ])


# --- U1, D1, F6, F7: reshape and text functions -----------------------------

def _wide_orders(spark: SparkSession, sf_dir: str, header: Callable[[str], str] = str) -> DataFrame:
    """All orders as a spreadsheet-like sheet: one row per customer (document
    read as a double), one column per Spanish month header from the first to
    the last order year, value = the lowest priority text ordered that month.

    Each month is one ``min`` over a small number (the place of the priority in
    its sorted list, decoded after), which a hash aggregate holds; one shuffle.
    The header list is the only thing taken to the driver: one aggregate row
    with the year range.  ``header`` rewrites the month headers.
    """
    orders = table(spark, sf_dir, "orders")
    lo, hi = orders.agg(F.min(F.year("o_orderdate")), F.max(F.year("o_orderdate"))).first()
    if lo is None:  # no dated order: one empty month column, so no rows come out
        lo = hi = 1970
    month = (F.year("o_orderdate") * 12 + F.month("o_orderdate")).alias("_month")
    codes = F.array(*[F.lit(p) for p in PRIORITIES])
    names = month_labels(lo, hi)
    numbers = [y * 12 + m for y in range(lo, hi + 1) for m in range(1, 13)]
    coded = orders.select(F.col("o_custkey").cast("double").alias("DOCUMENTO"), month,
                          F.array_position(codes, F.col("o_orderpriority")).cast("int").alias("_code"))
    wide = coded.groupBy("DOCUMENTO").agg(*[
        F.min(F.when(F.col("_month") == n, F.col("_code"))).alias(str(n)) for n in numbers])
    return wide.select("DOCUMENTO", *[
        F.when(col(str(n)) > 0, F.get(codes, col(str(n)) - 1)).alias(header(name))
        for n, name in zip(numbers, names, strict=True)])


def months_wide_to_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unpivot_to_dates(_wide_orders(spark, sf_dir), "DOCUMENTO")


def months_unpivot_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diagnoses_long(_wide_orders(spark, sf_dir), "DOCUMENTO")


def months_odd_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1 on headers with a dot, a backtick and quotes (each month has all of them)."""
    wide = _wide_orders(spark, sf_dir, lambda name: name.replace(" ", ".") + "`'\"")
    return unpivot_months(wide.withColumn("DOCUMENTO", document_text("DOCUMENTO")), "DOCUMENTO").where(
        "DIAGNOSTICO is not null")


def month_text_to_date_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", month_label("ts").alias("MES_ANO"))
    return events.select("event_id", "MES_ANO", month_text_to_date("MES_ANO").alias("FECHA"))


def month_text_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 with ``clean=True``: headers typed in lower case with a
    non-breaking space between month and year."""
    label = F.lower(F.regexp_replace(month_label("ts"), " ", "\u00a0"))
    events = table(spark, sf_dir, "events").select("event_id", label.alias("MES_ANO"))
    return events.select("event_id", "MES_ANO", month_text_to_date("MES_ANO", clean=True).alias("FECHA"))


def normalize_text_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select(
        F.lit("nation").alias("source"), F.col("n_nationkey").cast("bigint").alias("key"),
        F.col("n_name").alias("raw"))
    part = table(spark, sf_dir, "part").select(
        F.lit("part").alias("source"), F.col("p_partkey").alias("key"), F.col("p_name").alias("raw"))
    both = nation.unionByName(part)
    return both.withColumn("normalized", normalize_text("raw"))


def normalize_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7 over the whole texts of all documents, with spaces added at the ends
    and a decomposed accent appended."""
    raw = F.concat(F.lit(" \t"), F.col("text"), F.lit("e\u0301\u00a0 "))
    return table(spark, sf_dir, "documents").select("doc_id", normalize_text(raw).alias("normalized"))


def normalize_scripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7 over all documents' texts, each after a letter of another script."""
    letters = F.array(*[F.lit(c) for c in PLANTED_LETTERS])
    raw = F.concat(F.get(letters, (F.col("doc_id") % len(PLANTED_LETTERS)).cast("int")), F.lit(" "), F.col("text"), F.lit("e\u0301"))
    return table(spark, sf_dir, "documents").select("doc_id", normalize_text(raw).alias("normalized"))


def document_text_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    return customer.select("c_custkey", document_text(F.col("c_custkey").cast("double")).alias("DOCUMENTO"))


# --- Q2-Q5: quality --------------------------------------------------------

def orphans_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return quality.orphans(docs, table(spark, sf_dir, "labels"), "doc_id")


def filtered_orphans_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6 with a filter of the labels' keys ahead of the join."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return quality.filtered_orphans(docs, table(spark, sf_dir, "labels"), "doc_id")


def orphan_doc_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing foreign keys with their use count (aggregated before the join)."""
    return quality.orphan_keys(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")


def long_part_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4 row by row: part names longer than ten characters."""
    return quality.too_long(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_name", 10)


def domain_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return quality.outside_domain(orders, "o_orderstatus", ORDER_STATUS_DOMAIN)


def null_and_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    return quality.summary(customer, "customer", not_null=customer.columns,
                           max_length={"c_name": 18, "c_mktsegment": 9},
                           domains={"c_mktsegment": MARKET_SEGMENTS})


# --- A4-A6, W1: gold -------------------------------------------------------

def attention_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Counted per customer before joining (gold.count_by): the joins see one
    # row per customer instead of one per order.
    dims = [Dim(table(spark, sf_dir, "customer"), "c", [("o_custkey", "c_custkey")]),
            Dim(table(spark, sf_dir, "nation"), "n", [("c_nationkey", "n_nationkey")], parent="c")]
    return gold.count_by(table(spark, sf_dir, "orders"), dims, ["n.n_name", "c.c_custkey", "c.c_name"])


def mean_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.mean_gap(table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate")


def appointment_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.appointment_gaps(table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", "o_orderkey")


def diagnosis_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.diagnosis_by_month(table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderdate",
                                   "n_orders")


# --- N1, N2/N5: normalisation ------------------------------------------------

def extract_dimension_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    _, fact = extract_dimension(orders, "o_orderpriority", "PRIORITY_ID")
    return fact


def extract_dimension_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    dim, _ = extract_dimension(orders, "o_orderpriority", "PRIORITY_ID")
    return dim


def split_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    variants = F.array(
        F.col("p_type"), F.col("p_name"), F.concat_ws(" ", "p_name", "p_type"),
        F.concat_ws(" ", "p_name", "p_type", "p_brand"),
        F.concat(F.col("p_brand"), F.lit("  "), F.concat_ws(" ", "p_name", "p_type", "p_brand")))
    exploded = p.select("p_partkey", F.posexplode(variants).alias("variant", "full_name"))
    name = split_person_name("full_name")
    return exploded.select("p_partkey", (F.col("variant") + 1).alias("variant"), "full_name",
                           name["FIRST_NAME"].alias("FIRST_NAME"),
                           name["SECOND_NAME"].alias("SECOND_NAME"),
                           name["LAST_NAME"].alias("LAST_NAME"))


def _priority_catalogue(spark: SparkSession) -> DataFrame:
    return literal_table(spark, PRIORITY_CATALOGUE, "DIAG_ID long, CIE10_CODE string, DESCRIPTION string")


def _diagnosis_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    patients = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("PACDOC"), F.col("c_custkey").alias("PACID"))
    return diagnosis_matches(months_wide_to_long(spark, sf_dir), patients, _priority_catalogue(spark))


def diagnosis_fact_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered_diagnoses(_diagnosis_matches(spark, sf_dir))


def diagnosis_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_diagnoses(_diagnosis_matches(spark, sf_dir))


def _repeated_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches on a patient list where ten customers share each document, some
    documents are written in another way, and dates and diagnoses are null or
    unknown here and there (all derived from whole tables)."""
    customer = table(spark, sf_dir, "customer")
    number = F.floor(F.col("c_custkey") / 10)
    document = F.when(number % 7 == 0, F.concat(F.lit("CC "), number.cast("string"))).otherwise(number.cast("string"))
    patients = customer.select(document.alias("PACDOC"), F.col("c_custkey").alias("PACID"))
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    long = orders.select(
        F.when(key % 11 != 0, F.floor(F.col("o_custkey") / 10).cast("string")).alias("DOCUMENTO"),
        F.when(key % 13 != 0, F.trunc(F.col("o_orderdate").cast("date"), "month")).alias("FECHA"),
        F.when(key % 17 != 0, F.col("o_orderpriority")).alias("DIAGNOSTICO"))
    twice = _priority_catalogue(spark)
    return diagnosis_matches(long, patients, twice.unionByName(twice.withColumn("DIAG_ID", F.col("DIAG_ID") + 100)))


def diagnosis_fact_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N4 with repeated documents, codes and descriptions: no row multiplies."""
    return numbered_diagnoses(_repeated_matches(spark, sf_dir))


def diagnosis_rejects_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_diagnoses(_repeated_matches(spark, sf_dir))


# --- N1, N3, N6: bronze to silver ---------------------------------------------

def _bronze(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Bronze tables as texts, with bad values derived from the keys: customers
    as patients, orders as appointments, parts as specialities."""
    customer, orders, part = (table(spark, sf_dir, n) for n in ("customer", "orders", "part"))
    c, o = F.col("c_custkey"), F.col("o_orderkey")
    patient = customer.select(
        F.when(c % 19 == 0, F.concat(F.lit("x"), c.cast("string"))).otherwise(c.cast("string")).alias("PACID"),
        F.when(c % 23 != 0, c.cast("string")).alias("PACDOC"),
        F.concat(F.lit(" "), F.lower("c_name"), F.lit("  García "), F.col("c_mktsegment")).alias("PACNAME"),
        F.col("c_mktsegment").alias("PACCITY"),
        F.when(c % 29 == 0, F.lit("not a day")).otherwise(F.lit("2024-01-31 10:00:00")).alias("PACINGDAT"))
    attention = orders.select(
        o.cast("string").alias("ATTID"),
        F.when(o % 31 != 0, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("ATTFIN01"),
        F.lower("o_orderpriority").alias("ATTFIN02"), F.lower("o_orderstatus").alias("ATTFIN03"),
        F.when(o % 37 == 0, F.lit("3e")).otherwise(F.col("o_custkey").cast("string")).alias("ATTFIN04"),
        (o % 100).cast("string").alias("ATTFIN05"))
    speciality = part.select(F.col("p_partkey").cast("string").alias("SPEID"), F.col("p_name").alias("SPENAME"),
                             F.concat(F.col("p_brand"), F.lit(" Á")).alias("SPEGRP"))
    return {"patient": patient, "attention": attention, "speciality": speciality}


def erp_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.erp_patient(_bronze(spark, sf_dir)["patient"])


def erp_attentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appointments with both statuses keyed."""
    return normalize.erp_attention(_bronze(spark, sf_dir)["attention"])[0]


def erp_specialities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Specialities with their group keyed."""
    return normalize.erp_speciality(_bronze(spark, sf_dir)["speciality"])[0]


def erp_rejects_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What cannot become silver rows, counted by table and reason."""
    parts = [normalize.erp_rejects(df, name) for name, df in _bronze(spark, sf_dir).items()]
    return quality.report(parts).groupBy("table_name", "reason").agg(F.count(F.lit(1)).alias("rows"))


# --- Q6: one report of every check -------------------------------------------

def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` is scanned twice: for all rules and the keys of small
    dimensions, and aggregated by its key to the large one."""
    t = {n: table(spark, sf_dir, n) for n in
         ("lineitem", "orders", "part", "supplier", "customer", "documents", "labels")}
    li = t["lineitem"]
    return quality.report([
        quality.summary(li, "lineitem", not_null=["l_orderkey", "l_partkey", "l_suppkey", "l_shipdate"],
                        domains={"l_returnflag": [c for c, _ in RETURN_STATUS],
                                 "l_linestatus": [c for c, _ in LINE_STATUS]},
                        references=[("l_partkey", t["part"], "p_partkey"),
                                    ("l_suppkey", t["supplier"], "s_suppkey")]),
        quality.count_summary(quality.duplicate_keys(t["orders"], ["o_orderkey"]),
                              "primary_key", "orders", "o_orderkey"),
        quality.foreign_key_summary(li, t["orders"], "l_orderkey", "o_orderkey", "lineitem", "l_orderkey"),
        quality.summary(t["orders"], "orders", references=[("o_custkey", t["customer"], "c_custkey")]),
        quality.foreign_key_summary(t["documents"], t["labels"], "doc_id", None, "documents", "doc_id"),
    ])


def faulty_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every kind of rule on a table where each one fails for some rows."""
    bad = _faulty_orders(spark, sf_dir)
    return quality.report([
        quality.summary(bad, "orders", not_null=["key", "customer", "day"], max_length={"priority": 8},
                        domains={"status": ORDER_STATUS_DOMAIN},
                        references=[("customer", table(spark, sf_dir, "customer"), "c_custkey")]),
        quality.count_summary(quality.duplicate_keys(bad, ["key"]), "primary_key", "orders", "key"),
        quality.foreign_key_summary(bad, table(spark, sf_dir, "labels"), "key", "doc_id", "orders", "key"),
    ])


def _faulty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with null keys and days, unknown customers and repeated keys."""
    o = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.when(o % 7 == 0, o - 7).when(o % 41 != 0, o).alias("key"),
        F.when(o % 9 == 0, -F.col("o_custkey")).when(o % 43 != 0, F.col("o_custkey")).alias("customer"),
        F.when(o % 5 != 0, F.col("o_orderdate")).alias("day"),
        F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"))


def faulty_mean_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 where every fifth day is null."""
    return gold.mean_gap(_faulty_orders(spark, sf_dir), "customer", "day")


def faulty_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 with null customers, days and tie-breakers, and few rows to a hot key.

    Rows that tie on customer, day and key hand on the same values, so the sums
    do not depend on their order.
    """
    return gold.appointment_gaps(_faulty_orders(spark, sf_dir), "customer", "day", "key", hot_rows=4).groupBy("customer").agg(
        F.count(F.lit(1)).alias("gaps"), F.sum("gap_days").cast("bigint").alias("days"),
        F.count("prev_key").alias("known_before"))


def broadcast_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension broadcast after a check of its size."""
    dims = [Dim(table(spark, sf_dir, "nation"), "n", [("c_nationkey", "n_nationkey")], broadcast=True)]
    return star_join(table(spark, sf_dir, "customer"), dims, ["f.c_custkey", "n.n_name"])


# --- C7, J1: the health model from the provided tables ----------------------------

def _health_silver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The silver tables of the health model: customers as patients, orders as
    appointments, parts as specialities grouped by brand, order priority and
    status as the two statuses."""
    customer, orders, part = (table(spark, sf_dir, n) for n in ("customer", "orders", "part"))
    name = split_person_name(F.concat_ws(" ", "c_mktsegment", "c_name"))
    patient = customer.select(
        F.col("c_custkey").alias("PACID"), F.col("c_custkey").cast("string").alias("PACDOC"),
        name["FIRST_NAME"].alias("FIRST_NAME"), name["SECOND_NAME"].alias("SECOND_NAME"),
        name["LAST_NAME"].alias("LAST_NAME"), F.col("c_mktsegment").alias("PACCITY"),
        F.lit(None).cast("timestamp").alias("PACINGDAT"))
    group, speciality = extract_dimension(
        part.select(F.col("p_partkey").alias("SPEID"), F.col("p_name").alias("SPENAME"), "p_brand"),
        "p_brand", "SPEGRP_ID", "SPEGRP_NAME")
    coded = orders.select(
        F.col("o_orderkey").alias("ATTID"), F.col("o_custkey").alias("PACID"),
        (F.col("o_orderkey") % 300).alias("SPEID"), F.col("o_orderdate").cast("timestamp").alias("ATTFIN01"),
        "o_orderpriority", "o_orderstatus")
    assign, fact = extract_dimension(coded, "o_orderpriority", "ASSIGNMENT_STATUS_ID", "STATUS_DESC")
    assist, fact = extract_dimension(fact, "o_orderstatus", "ASSISTANCE_STATUS_ID", "ASSISTED")
    return {"dim_patient": patient, "dim_speciality": speciality, "dim_speciality_group": group,
            "dim_assignment_status": assign, "dim_assistance_status": assist, "fact_attention": fact}


def health_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detail_df(_health_silver(spark, sf_dir))


def health_detail_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detail_sql(spark, _health_silver(spark, sf_dir))


# --- loads in several batches ----------------------------------------------------
# Each writes its tables into a new folder of the shared checkpoint folder.

FIRST_LOAD = "o_orderdate < timestamp '1995-06-01'"


def _scratch(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/clinilake-{uuid.uuid4().hex}"


def stable_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N2, N5 over two loads: customers keyed by the first load keep their key,
    those that only the whole table has are numbered on."""
    orders, path = table(spark, sf_dir, "orders"), f"{_scratch(spark)}/dim_customer"
    first, _ = extract_dimension(orders.where(FIRST_LOAD), "o_custkey", "CUSTOMER_ID")
    snapshots.write_audited(first, path)
    whole, _ = normalize.extend_dimension(orders, "o_custkey", snapshots.read(spark, path), "CUSTOMER_ID")
    snapshots.write_audited(whole, path, lambda dim: quality.count_summary(
        quality.duplicate_keys(dim, ["CUSTOMER_ID"]), "primary_key", "dim_customer", "CUSTOMER_ID"))
    return snapshots.read(spark, path)


def published_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6 before publication: a clean part of the orders, a faulty write that the
    checks refuse, and all orders; what readers see in each version."""
    orders, path = table(spark, sf_dir, "orders"), f"{_scratch(spark)}/orders"

    def audit(df: DataFrame) -> DataFrame:
        return quality.report([
            quality.summary(df, "orders", not_null=["o_orderkey", "o_orderdate"]),
            quality.count_summary(quality.duplicate_keys(df, ["o_orderkey"]), "primary_key", "orders", "o_orderkey")])

    faulty = orders.withColumn("o_orderdate", F.when(F.col("o_orderpriority") != PRIORITIES[0], F.col("o_orderdate")))
    for rows in (orders.where(FIRST_LOAD), faulty, orders):
        try:
            snapshots.write_audited(rows, path, audit)
        except quality.QualityError:
            continue
    last, _ = snapshots.current(spark, path)
    return quality.report([
        snapshots.read(spark, path, v).agg(
            F.lit(v).cast("long").alias("version"), F.count(F.lit(1)).alias("orders"),
            F.countDistinct("o_custkey").alias("customers"), F.max("o_orderdate").alias("last_day"))
        for v in range(1, last + 1)])


def upserted_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders partitioned by month; the corrected ones of 1996 and 1997 are
    loaded on top, twice."""
    path = f"{_scratch(spark)}/orders_by_month"
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate",
        F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    corrected = orders.where(F.year("o_orderdate").isin(1996, 1997) & (F.col("o_orderpriority") == PRIORITIES[0])
                             ).withColumn("o_orderstatus", F.lit("CORRECTED"))
    for batch in (orders, corrected, corrected):
        sinks.upsert_partitions(batch, path, ["o_orderkey", "month"], ["month"])
    return spark.read.schema(orders.schema).parquet(path)


def _two_batches(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    return {"early": orders.where(FIRST_LOAD), "late": orders.where(f"not ({FIRST_LOAD}) or o_orderdate is null")}


def merged_mean_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 from the states of two batches, the second sent twice."""
    path, batches = f"{_scratch(spark)}/gap_state", _two_batches(spark, sf_dir)
    for name in ("early", "late", "late"):
        snapshots.merge_batch(increment.gap_state(batches[name], "o_custkey", "o_orderdate"), path, name,
                              increment.merge_gap_states)
    return increment.mean_gap_of(snapshots.read(spark, path))


def merged_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 from the states of two batches, the first sent twice."""
    path, batches = f"{_scratch(spark)}/month_state", _two_batches(spark, sf_dir)
    for name in ("early", "early", "late"):
        state = increment.month_state(batches[name], "o_orderpriority", "o_orderdate", "n_orders")
        snapshots.merge_batch(state, path, name, lambda old, new: increment.merge_counts(old, new, "n_orders"))
    return snapshots.read(spark, path)


def patched_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 where the urgent orders, of all dates, come after the others are linked."""
    orders, path = table(spark, sf_dir, "orders"), f"{_scratch(spark)}/links"
    late = F.coalesce(F.col("o_orderpriority") == PRIORITIES[0], F.lit(False))
    snapshots.write_audited(increment.links(orders.where(~late), "o_custkey", "o_orderdate", "o_orderkey"), path)
    linked = snapshots.read(spark, path)
    patch = increment.patched_links(linked, orders.where(late))
    snapshots.write_audited(increment.apply_links(linked, patch), path)
    return increment.gaps_of(snapshots.read(spark, path))


ORDER_LINE = "o_orderkey long, o_custkey long, o_orderstatus string"


def landed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S11 on all orders as JSON lines, some of them broken, ill-typed, spaced or
    with a field that the schema does not name; all lines can be rebuilt."""
    key = F.col("o_orderkey")
    plain = F.to_json(F.struct("o_orderkey", "o_custkey", "o_orderstatus"))
    line = (F.when(key % 11 == 0, F.concat(F.lit("{"), key.cast("string")))
            .when(key % 7 == 0, F.to_json(F.struct("o_orderkey", F.lit("none").alias("o_custkey"), "o_orderstatus")))
            .when(key % 5 == 0, F.to_json(F.struct("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")))
            .when(key % 3 == 0, F.replace(plain, F.lit(":"), F.lit(": "))).otherwise(plain))
    lines = table(spark, sf_dir, "orders").select(key.alias("no"), line.alias("value"), line.alias("sent"))
    landed = parse_lines(lines, "json", ORDER_LINE)
    return landed.select("no", "o_orderkey", "o_custkey", "o_orderstatus",
                         F.array_join(F.array_sort(F.map_keys("_rescued")), ",").alias("rescued"),
                         F.col("_raw").isNotNull().alias("kept_whole"),
                         (rebuilt(landed, "json", ORDER_LINE) == F.col("sent")).alias("rebuilt"))


LEDGER_KEY = ["l_partkey", "l_shipdate"]
LATE_LINES = "l_shipdate >= date '1997-01-01' or l_linenumber = 1"


def _ledger(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """All lines entered in two batches, the second sent twice; the ledger's path and the second batch."""
    lines, path = table(spark, sf_dir, "lineitem"), f"{_scratch(spark)}/ledger"
    late = F.coalesce(F.expr(LATE_LINES), F.lit(False))
    for rows, name in ((lines.where(~late), "early"), (lines.where(late), "late"), (lines.where(late), "late")):
        ledger.load(rows, path, LEDGER_KEY, name, buckets=8)
    return path, lines.where(late)


def ledger_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 for a batch: its keys that repeat, within it or with lines loaded before."""
    path, late = _ledger(spark, sf_dir)
    return ledger.duplicates(late, path, LEDGER_KEY, buckets=8)


def ledger_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 over all batches, from the ledger alone."""
    path, _ = _ledger(spark, sf_dir)
    return ledger.verdict(ledger.read(spark, path), LEDGER_KEY, "lineitem")


# --- C2, S5-S8: through the lake and back ------------------------------------------

def lake_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point 4 as a job: the health model's tables published in a lake's silver
    zone, the view built from there and read back from its gold zone."""
    lake = Lake(_scratch(spark), snapshots=True)
    for name, df in _health_silver(spark, sf_dir).items():
        sinks.write_zone(df, lake, "silver", name)
    jobs.build_detail(spark, lake, mode="sql")
    return read_zone(spark, lake, "gold", "atencion_detalle")


def written_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by status in sorted files, then one more batch appended, read back."""
    path, orders = f"{_scratch(spark)}/orders", table(spark, sf_dir, "orders")
    sinks.write_table(orders.where(FIRST_LOAD), path, partition_by=["o_orderstatus"], sort_by=["o_orderkey"])
    sinks.write_table(orders.where(f"not ({FIRST_LOAD})"), path, "append", partition_by=["o_orderstatus"])
    return read_tables(spark, path.rpartition("/")[0], ["orders"])["orders"].groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("o_orderkey").alias("keys"), F.max("o_orderdate").alias("last_day"))


def conformed_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as texts brought to the schema of ``dim_patient``, on top of its empty table."""
    customer = table(spark, sf_dir, "customer")
    texts = customer.select(
        F.col("c_custkey").cast("string").alias("PACID"), F.col("c_custkey").alias("PACDOC"), F.col("c_name").alias("FIRST_NAME"),
        F.lit(None).cast("string").alias("SECOND_NAME"), F.col("c_mktsegment").alias("LAST_NAME"), F.col("c_mktsegment").alias("PACCITY"),
        F.when(F.col("c_custkey") % 3 == 0, F.lit("2024-01-31 10:00:00")).otherwise(F.lit("no day")).alias("PACINGDAT"),
        F.lit("left out").alias("extra"))
    return schemas.empty(spark, "dim_patient").unionByName(schemas.conform(texts, schemas.DIM_PATIENT))


QUERIES: dict[str, Query] = {
    "lake_detail": lake_detail,
    "written_orders": written_orders,
    "conformed_patients": conformed_patients,
    "normalize_scripts": normalize_scripts,
    "landed_records": landed_records,
    "filtered_orphans": filtered_orphans_q,
    "ledger_duplicates": ledger_duplicates,
    "ledger_verdict": ledger_verdict,
    "stable_keys": stable_keys,
    "published_orders": published_orders,
    "upserted_orders": upserted_orders,
    "merged_mean_gap": merged_mean_gap,
    "merged_months": merged_months,
    "patched_gaps": patched_gaps,
    "star_detail": star_detail,
    "star_detail_sql": star_detail_sql,
    "natural_key_dups": natural_key_dups,
    "natural_key_dups_sql": natural_key_dups_sql,
    "detail_natural_key": detail_natural_key,
    "detail_attention_counts": detail_attention_counts,
    "detail_mean_gap": detail_mean_gap,
    "key_verdict": key_verdict,
    "months_wide_to_long": months_wide_to_long,
    "months_unpivot_literal": months_unpivot_literal,
    "month_text_to_date": month_text_to_date_q,
    "month_text_clean": month_text_clean,
    "normalize_text": normalize_text_q,
    "document_text": document_text_q,
    "orphans": orphans_q,
    "orphan_doc_keys": orphan_doc_keys,
    "long_part_names": long_part_names,
    "domain_violations": domain_violations,
    "null_and_length": null_and_length,
    "attention_counts": attention_counts,
    "mean_gap": mean_gap,
    "appointment_gaps": appointment_gaps,
    "diagnosis_by_month": diagnosis_by_month,
    "extract_dimension": extract_dimension_fact,
    "extract_dimension_dim": extract_dimension_dim,
    "split_name": split_name,
    "health_detail": health_detail,
    "health_detail_sql": health_detail_sql,
    "months_odd_headers": months_odd_headers,
    "normalize_documents": normalize_documents,
    "diagnosis_fact_repeated": diagnosis_fact_repeated,
    "diagnosis_rejects_repeated": diagnosis_rejects_repeated,
    "erp_patients": erp_patients,
    "erp_attentions": erp_attentions,
    "erp_specialities": erp_specialities,
    "erp_rejects": erp_rejects_q,
    "faulty_quality": faulty_quality,
    "faulty_mean_gap": faulty_mean_gap,
    "faulty_gaps": faulty_gaps,
    "broadcast_nation": broadcast_nation,
    "diagnosis_fact": diagnosis_fact_q,
    "diagnosis_rejects": diagnosis_rejects,
    "quality_report": quality_report,
}

_MONTH_LIST = "[" + ", ".join(f"'{m}'" for m in SPANISH_MONTHS) + "]"

_MONTHS_LONG = f"""
select cast(o_custkey as varchar) as DOCUMENTO,
       cast(date_trunc('month', o_orderdate) as date) as FECHA,
       min(o_orderpriority) as DIAGNOSTICO
from orders
where o_orderdate is not null
group by 1, 2
"""

# The star join written by hand, with implicit joins and CASE instead of the
# catalogues, so that it shares nothing with the statements under test.
_STAR = """
select l_orderkey, l_linenumber, l_shipdate as ship_date, p_partkey, p_name, p_brand, p_type,
       s_suppkey, s_name, n_name as supplier_nation,
       case l_returnflag when 'A' then 'ACCEPTED' when 'N' then 'NONE' when 'R' then 'RETURNED' end as return_status,
       case l_linestatus when 'F' then 'FULFILLED' when 'O' then 'OPEN' end as line_status, l_quantity
from lineitem, part, supplier, nation
where l_partkey = p_partkey and l_suppkey = s_suppkey and s_nationkey = n_nationkey
  and l_returnflag in ('A', 'N', 'R') and l_linestatus in ('F', 'O')
"""
_NATURAL_KEY = """
select distinct l_partkey, l_shipdate, n as conteo
from (select l_partkey, l_shipdate, count(*) over (partition by l_partkey, l_shipdate) as n from lineitem)
where n > 1"""


def _mean_gap_sql(source: str, entity: str, ts: str) -> str:
    """Means of the gaps that ``lag`` finds, row by row."""
    return f"""
        with gaps as (
          select {entity}, {ts},
                 datediff('day', lag({ts}) over w, {ts}) as d, epoch({ts}) - epoch(lag({ts}) over w) as s
          from ({source}) where {ts} is not null
          window w as (partition by {entity} order by {ts})),
        means as (
          select {entity}, min({ts}) as first_at, max({ts}) as last_at, sum(d) / count(d) as mean_gap_days,
                 sum(s) / (count(s) * 3600) as mean_gap_hours from gaps group by {entity}),
        sizes as (select {entity}, count(*) as appointments from ({source}) group by {entity})
        select sizes.{entity}, appointments, first_at, last_at, mean_gap_days, mean_gap_hours
        from sizes left join means on sizes.{entity} is not distinct from means.{entity}"""


_CATALOGUE_VALUES =", ".join(f"({i}, '{c}', '{d}')" for i, c, d in PRIORITY_CATALOGUE)

_DIAGNOSIS_MATCHED = f"""
with long as ({_MONTHS_LONG}),
cat (DIAG_ID, CIE10_CODE, DESCRIPTION) as (values {_CATALOGUE_VALUES}),
m as (
  select l.DOCUMENTO, l.FECHA, l.DIAGNOSTICO, c.c_custkey as PACID,
         cast(coalesce(bc.DIAG_ID, bd.DIAG_ID) as bigint) as DIAG_ID
  from long l
  left join customer c on cast(c.c_custkey as varchar) = l.DOCUMENTO
  left join cat bc on upper(trim(bc.CIE10_CODE)) = upper(trim(l.DIAGNOSTICO))
  left join cat bd on upper(strip_accents(trim(bd.DESCRIPTION))) = upper(strip_accents(trim(l.DIAGNOSTICO)))
)"""

_REPEATED_MATCHED = f"""
with long as (
  select case when o_orderkey % 11 <> 0 then cast(o_custkey // 10 as varchar) end as DOCUMENTO,
         case when o_orderkey % 13 <> 0 then cast(date_trunc('month', o_orderdate) as date) end as FECHA,
         case when o_orderkey % 17 <> 0 then o_orderpriority end as DIAGNOSTICO from orders),
cat (DIAG_ID, CIE10_CODE, DESCRIPTION) as (values {_CATALOGUE_VALUES}),
m as (
  select l.*, (select min(c_custkey) from customer
               where case when (c_custkey // 10) % 7 = 0 then 'CC ' else '' end || (c_custkey // 10) = l.DOCUMENTO) as PACID,
         cast(coalesce((select min(DIAG_ID) from cat where upper(trim(CIE10_CODE)) = upper(trim(l.DIAGNOSTICO))),
                       (select min(DIAG_ID) from cat
                        where upper(trim(DESCRIPTION)) = upper(trim(l.DIAGNOSTICO)))) as bigint) as DIAG_ID
  from long l)"""

_FACTS = """
        select row_number() over (order by DOCUMENTO, FECHA, DIAGNOSTICO, DIAG_ID) as PATDIAG_ID,
               PACID, DIAG_ID, FECHA as DATE
        from m where PACID is not null and DIAG_ID is not null and FECHA is not null"""
_REJECTS = """
        select DOCUMENTO, FECHA, DIAGNOSTICO,
               case when PACID is null then 'unknown patient'
                    when DIAG_ID is null then 'unknown diagnosis'
                    else 'unparsed month' end as reason
        from m where PACID is null or DIAG_ID is null or FECHA is null"""

_FAULTY = """
select case when o_orderkey % 7 = 0 then o_orderkey - 7 when o_orderkey % 41 <> 0 then o_orderkey end as key,
       case when o_orderkey % 9 = 0 then -o_custkey when o_orderkey % 43 <> 0 then o_custkey end as customer,
       case when o_orderkey % 5 <> 0 then o_orderdate end as day,
       o_orderpriority as priority, o_orderstatus as status from orders"""

_HEALTH = """
        select o_orderkey as ATTID, cast(o_orderdate as timestamp) as FECHA_ATENCION, c_custkey as PACID,
               cast(c_custkey as varchar) as PACDOC, c_mktsegment as FIRST_NAME,
               cast(null as varchar) as SECOND_NAME, c_name as LAST_NAME, c_mktsegment as PACCITY,
               cast(null as timestamp) as PACINGDAT, p_name as SPENAME, p_brand as SPEGRP_NAME,
               o_orderpriority as ESTADO_ASIGNACION, o_orderstatus as ASISTENCIA
        from orders join customer on c_custkey = o_custkey join part on p_partkey = o_orderkey % 300
        where o_orderpriority is not null and o_orderstatus is not null and p_brand is not null"""

_SPLIT_NAME = r"""
with v as (
  select p_partkey, 1 as variant, p_type as full_name from part
  union all select p_partkey, 2, p_name from part
  union all select p_partkey, 3, p_name || ' ' || p_type from part
  union all select p_partkey, 4, p_name || ' ' || p_type || ' ' || p_brand from part
  union all select p_partkey, 5, p_brand || '  ' || p_name || ' ' || p_type || ' ' || p_brand from part
), t as (
  select *, list_filter(string_split_regex(trim(full_name), '\s+'), lambda x: x <> '') as tok from v
)
select p_partkey, cast(variant as integer) as variant, full_name,
       case when len(tok) >= 1 then tok[1] end as FIRST_NAME,
       case when len(tok) >= 3 then tok[2] end as SECOND_NAME,
       case when len(tok) = 2 then tok[2]
            when len(tok) = 3 then tok[3]
            when len(tok) >= 4 then array_to_string(tok[3:], ' ') end as LAST_NAME
from t
"""

_NULL_AND_LENGTH = " union all ".join(
    [f"select 'not_null' as check_name, 'customer' as table_name, '{c}' as column_name, "
     f"count(*) filter (where {c} is null) as violations from customer"
     for c in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")]
    + [f"select 'max_length', 'customer', '{c}', count(*) filter (where length({c}) > {n}) from customer"
       for c, n in (("c_name", 18), ("c_mktsegment", 9))]
    + ["select 'domain', 'customer', 'c_mktsegment', count(*) filter (where c_mktsegment is not null "
       "and c_mktsegment not in (" + ", ".join(f"'{s}'" for s in MARKET_SEGMENTS) + ")) from customer"])

#: Queries that load tables in several steps: they write before they return.
LOADS = {"lake_detail", "written_orders", "stable_keys", "published_orders", "upserted_orders", "merged_mean_gap",
         "merged_months", "patched_gaps", "ledger_duplicates", "ledger_verdict"}

ORACLE: dict[str, str] = {
    "normalize_scripts": f"""
        select doc_id, list_extract({list(PLANTED_LETTERS.values())!r}, doc_id::integer % {len(PLANTED_LETTERS)} + 1) || ' '
               || upper(strip_accents(replace(text, 'ß', 'ss'))) || 'E' as normalized
        from documents""",
    "lake_detail": _HEALTH,
    "written_orders": """
        select o_orderstatus, count(*) as orders, cast(sum(o_orderkey) as bigint) as keys, max(o_orderdate) as last_day
        from orders where o_orderdate is not null group by o_orderstatus""",
    "conformed_patients": """
        select c_custkey as PACID, cast(c_custkey as varchar) as PACDOC, c_name as FIRST_NAME,
               cast(null as varchar) as SECOND_NAME, c_mktsegment as LAST_NAME, c_mktsegment as PACCITY,
               case when c_custkey % 3 = 0 then timestamp '2024-01-31 10:00:00' end as PACINGDAT
        from customer""",
    "filtered_orphans": """
        select doc_id, lang, source from documents where doc_id is null or doc_id not in
          (select doc_id from labels where doc_id is not null)""",
    "landed_records": """
        select o_orderkey as no, case when o_orderkey % 11 <> 0 then o_orderkey end as o_orderkey,
               case when o_orderkey % 11 <> 0 and o_orderkey % 7 <> 0 then o_custkey end as o_custkey,
               case when o_orderkey % 11 <> 0 then o_orderstatus end as o_orderstatus,
               case when o_orderkey % 11 = 0 then null when o_orderkey % 7 = 0 then 'o_custkey'
                    when o_orderkey % 5 = 0 then 'o_orderpriority' end as rescued,
               o_orderkey % 11 = 0 or o_orderkey % 7 = 0 or o_orderkey % 5 = 0 or o_orderkey % 3 = 0 as kept_whole,
               true as rebuilt
        from orders""",
    "ledger_duplicates": f"""
        select l_partkey, l_shipdate, count(*) as conteo from lineitem group by all
        having count(*) > 1 and bool_or({LATE_LINES})""",
    "ledger_verdict": """
        select 'lineitem' as table_name, 'l_partkey,l_shipdate' as key_columns, count(*) as dup_groups,
               cast(sum(n - 1) as bigint) as dup_rows, count(*) = 0 as is_unique
        from (select count(*) as n from lineitem group by l_partkey, l_shipdate having count(*) > 1)""",
    "stable_keys": f"""
        with first as (
          select o_custkey, row_number() over (order by o_custkey) as CUSTOMER_ID
          from (select distinct o_custkey from orders where o_custkey is not null and {FIRST_LOAD})),
        later as (
          select o_custkey, row_number() over (order by o_custkey) as n
          from (select distinct o_custkey from orders where o_custkey is not null
                and o_custkey not in (select o_custkey from first)))
        select CUSTOMER_ID, o_custkey from first
        union all select n + (select count(*) from first), o_custkey from later""",
    "published_orders": f"""
        select 1::bigint as version, count(*) as orders, count(distinct o_custkey) as customers, max(o_orderdate) as last_day
        from orders where {FIRST_LOAD}
        union all select 2, count(*), count(distinct o_custkey), max(o_orderdate) from orders""",
    "upserted_orders": """
        select o_orderkey, o_custkey, o_orderpriority, o_orderdate, strftime(o_orderdate, '%Y-%m') as month,
               case when year(o_orderdate) in (1996, 1997) and o_orderpriority = '1-URGENT' then 'CORRECTED'
                    else o_orderstatus end as o_orderstatus
        from orders""",
    "merged_mean_gap": _mean_gap_sql("select * from orders", "o_custkey", "o_orderdate"),
    "merged_months": """
        select o_orderpriority, date_trunc('month', o_orderdate)::date as month, count(*) as n_orders
        from orders group by all""",
    "patched_gaps": """
        select * from (
          select o_custkey, o_orderkey, o_orderdate, lag(o_orderkey) over w as prev_o_orderkey,
                 lag(o_orderdate) over w as prev_o_orderdate,
                 datediff('day', lag(o_orderdate) over w, o_orderdate)::integer as gap_days
          from orders window w as (partition by o_custkey order by o_orderdate, o_orderkey))
        where prev_o_orderkey is not null""",
    "star_detail": _STAR,
    "star_detail_sql": _STAR,
    "natural_key_dups": _NATURAL_KEY,
    "natural_key_dups_sql": _NATURAL_KEY,
    "detail_natural_key": f"""
        select distinct p_partkey, ship_date, n as conteo from (
          select p_partkey, ship_date, count(*) over (partition by p_partkey, ship_date) as n from ({_STAR}))
        where n > 1""",
    "detail_mean_gap": _mean_gap_sql(_STAR, "p_partkey", "ship_date"),
    "detail_attention_counts": """
        select s_name, l_partkey as p_partkey, count(*) as attentions
        from lineitem l join supplier s on l.l_suppkey = s.s_suppkey
        where exists (select 1 from part where p_partkey = l_partkey)
          and exists (select 1 from nation where n_nationkey = s_nationkey)
          and l_returnflag in ('A', 'N', 'R') and l_linestatus in ('F', 'O')
        group by s_name, l_partkey""",
    "faulty_mean_gap": _mean_gap_sql(_FAULTY, "customer", "day"),
    "faulty_gaps": f"""
        select customer, count(*) as gaps, cast(sum(datediff('day', before, day)) as bigint) as days,
               count(prev) as known_before
        from (select customer, day, lag(key) over w as prev, lag(day) over w as before, row_number() over w as n
              from ({_FAULTY})
              window w as (partition by customer order by day nulls first, key nulls first))
        where n > 1 group by customer""",
    "faulty_quality": f"""
        with bad as ({_FAULTY})
        select 'not_null' as check_name, 'orders' as table_name, 'key' as column_name,
               count(*) filter (where key is null) as violations from bad
        union all select 'not_null', 'orders', 'customer', count(*) filter (where customer is null) from bad
        union all select 'not_null', 'orders', 'day', count(*) filter (where day is null) from bad
        union all select 'max_length', 'orders', 'priority', count(*) filter (where length(priority) > 8) from bad
        union all select 'domain', 'orders', 'status', count(*) filter (where status not in ('F', 'O')) from bad
        union all select 'foreign_key', 'orders', 'customer', count(*) from bad
               where not exists (select 1 from customer c where c.c_custkey = bad.customer)
        union all select 'primary_key', 'orders', 'key', count(*)
               from (select key from bad group by key having count(*) > 1)
        union all select 'foreign_key', 'orders', 'key', count(*) from bad
               where not exists (select 1 from labels l where l.doc_id = bad.key)""",
    "health_detail": _HEALTH,
    "health_detail_sql": _HEALTH,
    "months_odd_headers": f"""
        select cast(o_custkey as varchar) as DOCUMENTO,
               {_MONTH_LIST}[month(o_orderdate)] || '.' || cast(year(o_orderdate) as varchar) || chr(96) || chr(39)
               || chr(34) as MES_ANO, min(o_orderpriority) as DIAGNOSTICO
        from orders where o_orderdate is not null group by 1, 2""",
    "normalize_documents": r"""
        select doc_id, upper(strip_accents(replace(regexp_replace(text, '^\s+', ''), 'ß', 'ss'))) || 'E' as normalized
        from documents""",
    "diagnosis_fact_repeated": _REPEATED_MATCHED + _FACTS,
    "diagnosis_rejects_repeated": _REPEATED_MATCHED + _REJECTS,
    "erp_patients": """
        select c_custkey as PACID, cast(c_custkey as varchar) as PACDOC, upper(c_name) as FIRST_NAME,
               'GARCIA' as SECOND_NAME, c_mktsegment as LAST_NAME, c_mktsegment as PACCITY,
               timestamp '2024-01-31 10:00:00' as PACINGDAT
        from customer where c_custkey % 19 <> 0 and c_custkey % 23 <> 0 and c_custkey % 29 <> 0""",
    "erp_attentions": """
        select o_orderkey as ATTID, o_custkey as PACID, o_orderkey % 100 as SPEID,
               cast(date_trunc('second', cast(o_orderdate as timestamp)) as timestamp) as ATTFIN01,
               dense_rank() over (order by upper(o_orderpriority)) as ASSIGNMENT_STATUS_ID,
               dense_rank() over (order by upper(o_orderstatus)) as ASSISTANCE_STATUS_ID
        from orders where o_orderkey % 31 <> 0 and o_orderkey % 37 <> 0 and o_orderdate is not null""",
    "erp_specialities": """
        select p_partkey as SPEID, upper(p_name) as SPENAME, dense_rank() over (order by upper(p_brand)) as SPEGRP_ID
        from part""",
    "erp_rejects": """
        with found as (
          select 'patient' as table_name,
                 case when c_custkey % 23 = 0 then 'PACDOC is missing'
                      when c_custkey % 19 = 0 then 'PACID is not a long'
                      when c_custkey % 29 = 0 then 'PACINGDAT is not a timestamp' end as reason from customer
          union all
          select 'attention', case when o_orderkey % 31 = 0 then 'ATTFIN01 is missing'
                                   when o_orderkey % 37 = 0 then 'ATTFIN04 is not a long' end from orders)
        select table_name, reason, count(*) as rows from found where reason is not null group by 1, 2""",
    "broadcast_nation": """
        select c_custkey, n_name from customer, nation where c_nationkey = n_nationkey""",
    "key_verdict": """
        select 'orders' as table_name, 'o_orderkey' as key_columns,
               count(*) as dup_groups, cast(coalesce(sum(c - 1), 0) as bigint) as dup_rows,
               count(*) = 0 as is_unique
        from (select o_orderkey, count(*) as c from orders group by 1 having count(*) > 1)
        union all
        select 'lineitem', 'l_orderkey,l_linenumber', count(*),
               cast(coalesce(sum(c - 1), 0) as bigint), count(*) = 0
        from (select l_orderkey, l_linenumber, count(*) as c from lineitem
              group by 1, 2 having count(*) > 1)""",
    "months_wide_to_long": _MONTHS_LONG,
    "months_unpivot_literal": _MONTHS_LONG,
    "month_text_to_date": f"""
        select event_id, {_MONTH_LIST}[month(ts)] || ' ' || cast(year(ts) as varchar) as MES_ANO,
               cast(date_trunc('month', ts) as date) as FECHA
        from events""",
    "month_text_clean": f"""
        select event_id,
               lower({_MONTH_LIST}[month(ts)] || chr(160) || cast(year(ts) as varchar)) as MES_ANO,
               cast(date_trunc('month', ts) as date) as FECHA
        from events""",
    "orphan_doc_keys": """
        select doc_id, count(*) as "references" from documents d
        where not exists (select 1 from labels l where l.doc_id = d.doc_id)
        group by doc_id""",
    "long_part_names": "select p_partkey, p_name from part where length(p_name) > 10",
    "normalize_text": """
        select 'nation' as source, cast(n_nationkey as bigint) as key, n_name as raw,
               upper(strip_accents(trim(n_name))) as normalized from nation
        union all
        select 'part', p_partkey, p_name, upper(strip_accents(trim(p_name))) from part""",
    "document_text": "select c_custkey, cast(c_custkey as varchar) as DOCUMENTO from customer",
    "orphans": """
        select d.doc_id, d.lang, d.source from documents d
        where not exists (select 1 from labels l where l.doc_id = d.doc_id)""",
    "domain_violations": """
        select o_orderkey, o_orderstatus from orders
        where o_orderstatus not in ('F', 'O')""",
    "null_and_length": _NULL_AND_LENGTH,
    "attention_counts": """
        select n.n_name, c.c_custkey, c.c_name, count(*) as attentions
        from orders o join customer c on c.c_custkey = o.o_custkey
        join nation n on n.n_nationkey = c.c_nationkey
        group by 1, 2, 3""",
    "mean_gap": _mean_gap_sql("select * from orders", "o_custkey", "o_orderdate"),
    "appointment_gaps": """
        select * from (
          select o_custkey, o_orderkey, o_orderdate,
                 lag(o_orderkey) over w as prev_o_orderkey,
                 lag(o_orderdate) over w as prev_o_orderdate,
                 cast(datediff('day', lag(o_orderdate) over w, o_orderdate) as integer) as gap_days
          from orders
          window w as (partition by o_custkey order by o_orderdate, o_orderkey))
        where prev_o_orderkey is not null""",
    "diagnosis_by_month": """
        select o_orderpriority, cast(date_trunc('month', o_orderdate) as date) as month,
               count(*) as n_orders
        from orders group by 1, 2""",
    "extract_dimension": """
        select o_orderkey,
               case when o_orderpriority is not null then
                 dense_rank() over (order by o_orderpriority) end as PRIORITY_ID
        from orders""",
    "extract_dimension_dim": """
        select row_number() over (order by o_orderpriority) as PRIORITY_ID,
               o_orderpriority
        from (select distinct o_orderpriority from orders where o_orderpriority is not null)""",
    "split_name": _SPLIT_NAME,
    "diagnosis_fact": _DIAGNOSIS_MATCHED + _FACTS,
    "diagnosis_rejects": _DIAGNOSIS_MATCHED + _REJECTS,
    "quality_report": """
        select 'not_null' as check_name, 'lineitem' as table_name, 'l_orderkey' as column_name,
               count(*) filter (where l_orderkey is null) as violations from lineitem
        union all select 'not_null', 'lineitem', 'l_partkey', count(*) filter (where l_partkey is null) from lineitem
        union all select 'not_null', 'lineitem', 'l_suppkey', count(*) filter (where l_suppkey is null) from lineitem
        union all select 'not_null', 'lineitem', 'l_shipdate', count(*) filter (where l_shipdate is null) from lineitem
        union all select 'domain', 'lineitem', 'l_returnflag',
               count(*) filter (where l_returnflag not in ('A', 'N', 'R')) from lineitem
        union all select 'domain', 'lineitem', 'l_linestatus',
               count(*) filter (where l_linestatus not in ('F', 'O')) from lineitem
        union all select 'primary_key', 'orders', 'o_orderkey', count(*)
               from (select o_orderkey from orders group by 1 having count(*) > 1)
        union all select 'foreign_key', 'lineitem', 'l_orderkey', count(*) from lineitem l
               where not exists (select 1 from orders o where o.o_orderkey = l.l_orderkey)
        union all select 'foreign_key', 'lineitem', 'l_partkey', count(*) from lineitem l
               where not exists (select 1 from part p where p.p_partkey = l.l_partkey)
        union all select 'foreign_key', 'lineitem', 'l_suppkey', count(*) from lineitem l
               where not exists (select 1 from supplier s where s.s_suppkey = l.l_suppkey)
        union all select 'foreign_key', 'orders', 'o_custkey', count(*) from orders o
               where not exists (select 1 from customer c where c.c_custkey = o.o_custkey)
        union all select 'foreign_key', 'documents', 'doc_id', count(*) from documents d
               where not exists (select 1 from labels l where l.doc_id = d.doc_id)""",
}
