"""Gold indicators.

All are single hash aggregations (partial + final) except the per-pair gaps,
which use the skew-safe :func:`clinilake.operators.ordered.lag_within`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinilake.names import col, fresh
from clinilake.operators.joins import Dim, star_join
from clinilake.operators.ordered import HOT_ROWS, lag_within


def attention_counts(detail: DataFrame, by: Sequence[str] = ("SPENAME", "PACDOC"),
                     count_col: str = "attentions") -> DataFrame:
    """Appointments per speciality and patient (A4)."""
    return detail.groupBy(*by).agg(F.count(F.lit(1)).alias(count_col))


def count_by(fact: DataFrame, dims: Sequence[Dim], by: Sequence[str],
             count_col: str = "attentions", fact_alias: str = "f") -> DataFrame:
    """Fact rows per dimension attributes, aggregated before the joins.

    Same counts as grouping ``star_join(fact, dims)`` by ``by`` (qualified
    ``alias.column`` names), but the fact is first counted per combination
    of its foreign keys (map-side partial aggregation), so the joins see one
    row per combination instead of one per fact row.  Exact for inner and
    left joins and repeated dimension keys: fact rows with the same keys
    join the same way.  ``by`` may name columns of the fact too.  An attribute
    keeps its plain name unless two of them share it; those keep the qualified
    one.
    """
    fks = list(dict.fromkeys(lc for d in dims if not d.parent for lc, _ in d.on))
    owners = [b.rpartition(".") for b in by]
    own = [c for a, _, c in owners if a == fact_alias]
    n, *names = fresh(["n", *[f"by{i}" for i in range(len(by))]], fact.columns)
    counted = fact.groupBy(*[col(c) for c in dict.fromkeys([*fks, *own])]).agg(F.count(F.lit(1)).alias(n))
    # Attributes get a name each: two dimensions may share one.
    joined = star_join(counted, dims, [*[F.col(b).alias(x) for b, x in zip(by, names, strict=True)],
                                       F.col(f"{fact_alias}.{n}").alias(n)], fact_alias=fact_alias)
    plain = [c for _, _, c in owners]
    out = [c if plain.count(c) == 1 else b for b, c in zip(by, plain, strict=True)]
    return joined.groupBy(*names).agg(F.sum(n).alias(count_col)).select(
        *[F.col(x).alias(c) for x, c in zip(names, out, strict=True)], count_col)


def mean_gap(df: DataFrame, entity: str = "PACDOC", ts: str = "FECHA_ATENCION") -> DataFrame:
    """Mean days between consecutive appointments of each entity (A5).

    The mean of consecutive gaps telescopes to ``(last - first) / (n - 1)``, so
    no sort is needed: one partial/final aggregation, exact in whole days,
    null for an entity with one appointment.  ``mean_gap_hours`` gives the same
    for timestamps at second precision.  ``appointments`` counts all rows; rows
    without a timestamp make no gap.
    """
    n = F.count(ts)
    first, last = F.min(ts), F.max(ts)
    return df.groupBy(entity).agg(
        F.count(F.lit(1)).alias("appointments"), first.alias("first_at"), last.alias("last_at"),
        F.try_divide(F.datediff(last, first), n - 1).alias("mean_gap_days"),
        F.try_divide(F.timestamp_diff("SECOND", first, last), (n - 1) * 3600).alias("mean_gap_hours"))


def appointment_gaps(df: DataFrame, entity: str = "PACDOC", ts: str = "FECHA_ATENCION",
                     tiebreak: str = "ATTID", partitions: int | None = None,
                     hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row per consecutive pair of appointments of an entity.

    Order is ``(ts, tiebreak)``, nulls first; the first appointment has no
    row, every other one has, also after a null tiebreak.  Columns: entity,
    tiebreak, ts, ``prev_<tiebreak>``, ``prev_<ts>``, ``gap_days``.
    """
    (seen,) = fresh(["seen"], df.columns)
    lagged = lag_within(df.select(col(entity), col(ts), col(tiebreak), F.lit(True).alias(seen)), entity,
                        [ts, tiebreak], [ts, tiebreak, seen], partitions=partitions, hot_rows=hot_rows)
    return (lagged.where(F.col(f"prev_{seen}"))
                  .select(col(entity), col(tiebreak), col(ts), col(f"prev_{tiebreak}"), col(f"prev_{ts}"),
                          F.datediff(col(ts), col(f"prev_{ts}")).alias("gap_days")))


def diagnosis_by_month(df: DataFrame, diagnosis: str = "DIAG_ID", date: str = "DATE",
                       count_col: str = "diagnoses") -> DataFrame:
    """Diagnoses per month, for their evolution over time."""
    month = F.trunc(F.col(date).cast("date"), "month")
    return df.groupBy(F.col(diagnosis), month.alias("month")).agg(F.count(F.lit(1)).alias(count_col))
