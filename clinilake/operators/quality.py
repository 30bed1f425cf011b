"""Data-quality operators (A1-A3, Q1-Q6).

Each check is a lazy DataFrame.  Aggregating checks use one hash aggregate
with map-side partial aggregation, so a hot key costs one partial row per
task, not a hot reducer.  Summary checks evaluate every rule of a table in a
single scan (one ``count_if`` per rule) and then unpivot that one row.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinilake.names import col as column, fresh

COUNT_COL = "conteo"


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_col: str = COUNT_COL) -> DataFrame:
    """Key groups that occur more than once, with their row count (A1, A2).

    Null keys group together, as in SQL ``GROUP BY``.
    """
    return (df.groupBy(*[column(k) for k in keys]).agg(F.count(F.lit(1)).alias(count_col))
              .where(F.col(count_col) > 1))


def is_unique(df: DataFrame, keys: Sequence[str]) -> bool:
    """True when no key group repeats (A3).  Stops at the first duplicate."""
    return duplicate_keys(df, keys).isEmpty()


def key_verdict(df: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    """One row: duplicate groups, surplus rows and the verdict (A3).

    ``dup_rows`` counts rows beyond the first of each duplicated group; the
    original check's message reports groups, so both are given.
    """
    dups = duplicate_keys(df, keys)
    return dups.agg(
        F.lit(table).alias("table_name"),
        F.lit(",".join(keys)).alias("key_columns"),
        F.count(F.lit(1)).alias("dup_groups"),
        F.coalesce(F.sum(F.col(COUNT_COL) - 1), F.lit(0)).cast("bigint").alias("dup_rows"),
        (F.count(F.lit(1)) == 0).alias("is_unique"))


def orphans(fact: DataFrame, dim: DataFrame, fk: str | Sequence[str],
            pk: str | Sequence[str] | None = None) -> DataFrame:
    """Fact rows whose foreign key has no dimension row (Q2, ``NOT EXISTS``).

    Rows with a null key are orphans too.  Only the dimension keys are read;
    Spark broadcasts them when small and otherwise sort-merges, with AQE
    splitting skewed fact partitions.
    """
    fks = [fk] if isinstance(fk, str) else list(fk)
    pks = fks if pk is None else ([pk] if isinstance(pk, str) else list(pk))
    names = fresh([f"pk{i}" for i in range(len(pks))], fact.columns)
    keys = dim.select(*[column(p).alias(n) for p, n in zip(pks, names, strict=True)])
    cond = None
    for f, n in zip(fks, names, strict=True):
        c = column(f) == F.col(n)
        cond = c if cond is None else cond & c
    return fact.join(keys, cond, "left_anti")


#: Bits of a key filter: 512 KB, whatever the number of keys.
FILTER_BITS = 1 << 22


def key_filter(keys: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """One row with one column, ``bits``: a Bloom filter of the rows of ``keys``.

    An array of ``bits / 64`` numbers (``bits`` is a power of two) in which each
    key sets two bits, made by one aggregation with at most that many groups.  A
    key whose bits are not all set is surely missing; of the missing keys a share of
    about ``(1 - exp(-2 n / bits))**2`` looks present (0.6 % for 200,000 keys, nearly
    all for many millions, for which more bits pay).
    """
    places = F.array(*_places([column(c) for c in keys.columns], bits))
    words = keys.select(F.explode(places).alias("p")).select(
        F.shiftright("p", 6).alias("w"), F.expr("shiftleft(1L, cast(p & 63 as int))").alias("m"))
    every = keys.sparkSession.range(bits // 64).select(F.col("id").alias("w"), F.lit(0).cast("long").alias("m"))
    whole = words.unionByName(every).groupBy("w").agg(F.bit_or("m").alias("m"))
    return whole.agg(F.sort_array(F.collect_list(F.struct("w", "m")))["m"].alias("bits"))


def _places(key: Sequence[Column], bits: int) -> list[Column]:
    h = F.xxhash64(*key)
    return [h.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(bits - 1))]


def surely_missing(df: DataFrame, cols: Sequence[str], filter_row: DataFrame, name: str,
                   bits: int = FILTER_BITS) -> DataFrame:
    """``df`` with the boolean ``name``: the key is in no row that the filter was made of.

    The filter is a one-row subquery; no row carries it and nothing is joined.
    The key's columns must have the types of the filter's.
    """
    whole, a, b = fresh(["bits", "a", "b"], [*df.columns, name])
    first, second = _places([column(c) for c in cols], bits)
    placed = df.select("*", filter_row.scalar().alias(whole), first.alias(a), second.alias(b))

    def is_set(place: str) -> Column:
        word = F.get(F.col(whole), F.shiftright(place, 6).cast("int"))
        return F.expr(f"shiftleft(1L, cast(`{place}` & 63 as int))").bitwiseAND(word) != 0

    return placed.withColumn(name, ~(is_set(a) & is_set(b))).drop(whole, a, b)


def filtered_orphans(fact: DataFrame, dim: DataFrame, fk: str | Sequence[str],
                     pk: str | Sequence[str] | None = None, bits: int = FILTER_BITS) -> DataFrame:
    """The rows of :func:`orphans`, where most rows that have no partner need no join.

    A :func:`key_filter` of the dimension's keys goes ahead of the join: rows
    whose key is surely missing (or null) go straight out, whole, without a shuffle;
    the rest meets the exact anti join.  It pays where many rows are orphans and
    the dimension is too large to broadcast; ``fact`` is read once for each way.
    """
    fks = [fk] if isinstance(fk, str) else list(fk)
    pks = fks if pk is None else [pk] if isinstance(pk, str) else list(pk)
    (missing,) = fresh(["missing"], fact.columns)
    keys = dim.select(*[column(p).try_cast(fact.schema[f].dataType).alias(f"k{i}")
                        for i, (f, p) in enumerate(zip(fks, pks, strict=True))]).dropna().distinct()
    null = F.lit(False)
    for f in fks:
        null = null | column(f).isNull()
    told = surely_missing(fact, fks, key_filter(keys, bits), missing, bits)
    sure = told.where(F.col(missing) | null).drop(missing)
    return sure.unionByName(orphans(told.where(~F.col(missing) & ~null).drop(missing), dim, fk, pk))


def orphan_keys(fact: DataFrame, dim: DataFrame, fk: str | Sequence[str],
                pk: str | Sequence[str] | None = None, count_col: str = "references") -> DataFrame:
    """Missing foreign-key values, each with the number of fact rows using it.

    The fact is aggregated per key before the anti join (map-side partial
    aggregation), so the shuffle carries distinct keys per task, not fact
    rows, and a key used by a third of the fact costs one row per task.  A
    null key is reported as missing.
    """
    fks = [fk] if isinstance(fk, str) else list(fk)
    counted = fact.groupBy(*[column(f) for f in fks]).agg(F.count(F.lit(1)).alias(count_col))
    return orphans(counted, dim, fks, pk)


def foreign_key_summary(fact: DataFrame, dim: DataFrame, fk: str | Sequence[str],
                        pk: str | Sequence[str] | None, table: str, column: str) -> DataFrame:
    """Orphan fact rows of one foreign key as a summary row (Q2)."""
    return orphan_keys(fact, dim, fk, pk).agg(
        F.lit("foreign_key").alias("check_name"), F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.coalesce(F.sum("references"), F.lit(0)).cast("bigint").alias("violations"))


def outside_domain(df: DataFrame, col: str, domain: Iterable[str]) -> DataFrame:
    """Rows whose non-null ``col`` is not one of ``domain`` (Q3)."""
    return df.where(column(col).isNotNull() & ~column(col).isin(list(domain)))


def too_long(df: DataFrame, col: str, max_length: int) -> DataFrame:
    """Rows whose ``col`` has more than ``max_length`` characters (Q4)."""
    return df.where(F.length(column(col)) > max_length)


def _rules(df: DataFrame, not_null: Sequence[str] = (), max_length: dict[str, int] | None = None,
           domains: dict[str, Sequence[str]] | None = None) -> list[tuple[str, str, Column]]:
    rules = [("not_null", c, column(c).isNull()) for c in not_null]
    rules += [("max_length", c, F.length(column(c)) > n) for c, n in (max_length or {}).items()]
    rules += [("domain", c, column(c).isNotNull() & ~column(c).isin(list(v)))
              for c, v in (domains or {}).items()]
    return rules


Reference = tuple[str, DataFrame, str]


def summary(df: DataFrame, table: str, not_null: Sequence[str] = (),
            max_length: dict[str, int] | None = None,
            domains: dict[str, Sequence[str]] | None = None,
            references: Sequence[Reference] = ()) -> DataFrame:
    """Violations per rule of one table in one scan (Q2-Q5).

    Columns: ``check_name, table_name, column_name, violations``.
    ``references`` are foreign keys ``(column, dimension, its key)`` counted in
    the same scan: the table is left-joined to each dimension's distinct keys.
    Meant for dimensions small enough that Spark broadcasts their keys; for a
    large one :func:`foreign_key_summary` aggregates the table first.
    """
    rules = _rules(df, not_null, max_length, domains)
    joined = df
    for (fk, dim, pk), name in zip(references, fresh([f"ref{i}" for i in range(len(references))], df.columns),
                                   strict=True):
        keys = dim.where(column(pk).isNotNull()).select(column(pk).alias(name)).distinct()
        joined = joined.join(keys, column(fk) == F.col(name), "left")
        rules.append(("foreign_key", fk, F.col(name).isNull()))
    if not rules:
        raise ValueError("no rule to check")
    counts = joined.agg(*[F.count_if(cond).alias(f"_r{i}") for i, (_, _, cond) in enumerate(rules)])
    cells = F.array(*[F.struct(F.lit(kind).alias("check_name"), F.lit(table).alias("table_name"),
                               F.lit(name).alias("column_name"),
                               F.col(f"_r{i}").cast("bigint").alias("violations"))
                      for i, (kind, name, _) in enumerate(rules)])
    return counts.select(F.inline(cells))


def null_violations(df: DataFrame, schema, table: str) -> DataFrame:
    """Not-null check of every column declared non-nullable in ``schema`` (Q5)."""
    return summary(df, table, not_null=[f.name for f in schema if not f.nullable])


def report(parts: Iterable[DataFrame]) -> DataFrame:
    """Union of check summaries into one table (Q6)."""
    parts = list(parts)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def count_summary(df: DataFrame, check: str, table: str, column: str) -> DataFrame:
    """A row-returning check (orphans, duplicates) as one summary row."""
    return df.agg(F.lit(check).alias("check_name"), F.lit(table).alias("table_name"),
                  F.lit(column).alias("column_name"),
                  F.count(F.lit(1)).cast("bigint").alias("violations"))


class QualityError(ValueError):
    """Raised by :func:`assert_clean` with the failing rules."""


def assert_clean(report_df: DataFrame, tolerated: Iterable[tuple[str, str, str]] = ()) -> None:
    """Gate for promotion (Q6): raise if any rule of a report has violations.

    Only the failing rule rows (at most one per rule) reach the driver.
    ``tolerated`` lists ``(check_name, table_name, column_name)`` to ignore.
    """
    skip = set(tolerated)
    failing = [r for r in report_df.where(F.col("violations") > 0).collect()
               if (r["check_name"], r["table_name"], r["column_name"]) not in skip]
    if failing:
        lines = [f"{r['check_name']} {r['table_name']}.{r['column_name']}: {r['violations']}"
                 for r in failing]
        raise QualityError("quality checks failed: " + "; ".join(sorted(lines)))
