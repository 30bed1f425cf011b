"""Gold indicators kept up to date batch by batch.

A stored *state* has one row per group with what two batches can merge: counts
add up, first and last dates extend.  The state of a batch is one aggregation of
the batch alone, merging is one aggregation of two tables of groups, and the
indicator is a projection of the state; the facts already loaded are not
read again.  :func:`clinilake.snapshots.merge_batch` stores a state so that a
repeated load changes nothing.

Gaps between consecutive appointments (W1) are not a sum.  They are stored as
*links*: every appointment with the one before it.  A batch, however late its
dates, changes the links of its own rows and of their new successors only;
:func:`patched_links` finds those, reading the batch's entities alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinilake.names import col, fresh
from clinilake.operators.ordered import HOT_ROWS, lag_within


def count_state(df: DataFrame, by: Sequence[str], count_col: str = "attentions") -> DataFrame:
    """Rows per group: the state of A4 and A6 counts."""
    return df.groupBy(*[col(c) for c in by]).agg(F.count(F.lit(1)).alias(count_col))


def merge_counts(old: DataFrame, new: DataFrame, count_col: str = "attentions") -> DataFrame:
    """Two count states as one."""
    by = [c for c in old.columns if c != count_col]
    return old.unionByName(new).groupBy(*[col(c) for c in by]).agg(F.sum(col(count_col)).alias(count_col))


def month_state(df: DataFrame, diagnosis: str = "DIAG_ID", date: str = "DATE",
                count_col: str = "diagnoses") -> DataFrame:
    """Diagnoses per month: the state of A6 (merged by :func:`merge_counts`)."""
    month = F.trunc(col(date).cast("date"), "month").alias("month")
    return df.groupBy(col(diagnosis), month).agg(F.count(F.lit(1)).alias(count_col))


def gap_state(df: DataFrame, entity: str = "PACDOC", ts: str = "FECHA_ATENCION") -> DataFrame:
    """Per entity: appointments, those with a date, first and last date (A5)."""
    return df.groupBy(col(entity)).agg(
        F.count(F.lit(1)).alias("appointments"), F.count(col(ts)).alias("dated"),
        F.min(col(ts)).alias("first_at"), F.max(col(ts)).alias("last_at"))


def merge_gap_states(old: DataFrame, new: DataFrame) -> DataFrame:
    """Two gap states as one."""
    entity = old.columns[0]
    return old.unionByName(new).groupBy(col(entity)).agg(
        F.sum("appointments").alias("appointments"), F.sum("dated").alias("dated"),
        F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"))


def mean_gap_of(state: DataFrame) -> DataFrame:
    """The mean gaps of :func:`clinilake.operators.gold.mean_gap` from a gap state."""
    pairs = F.col("dated") - 1
    return state.select(
        col(state.columns[0]), "appointments", "first_at", "last_at",
        F.try_divide(F.datediff("last_at", "first_at"), pairs).alias("mean_gap_days"),
        F.try_divide(F.timestamp_diff("SECOND", F.col("first_at"), F.col("last_at")), pairs * 3600)
        .alias("mean_gap_hours"))


def links(df: DataFrame, entity: str = "PACDOC", ts: str = "FECHA_ATENCION", tiebreak: str = "ATTID",
          hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every appointment and the one before it: entity, ts, tiebreak, ``prev_*``, linked.

    ``linked`` is false on an entity's first appointment.  Order and nulls are
    those of :func:`clinilake.operators.gold.appointment_gaps`.
    """
    (seen,) = fresh(["seen"], df.columns)
    rows = df.select(col(entity), col(ts), col(tiebreak), F.lit(True).alias(seen))
    lagged = lag_within(rows, entity, [ts, tiebreak], [ts, tiebreak, seen], hot_rows=hot_rows)
    return lagged.select(col(entity), col(ts), col(tiebreak), col(f"prev_{ts}"), col(f"prev_{tiebreak}"),
                         F.coalesce(col(f"prev_{seen}"), F.lit(False)).alias("linked"))


def gaps_of(linked: DataFrame) -> DataFrame:
    """The rows of :func:`clinilake.operators.gold.appointment_gaps` from links."""
    entity, ts, tiebreak = linked.columns[:3]
    return linked.where("linked").select(
        col(entity), col(tiebreak), col(ts), col(f"prev_{tiebreak}"), col(f"prev_{ts}"),
        F.datediff(col(ts), col(f"prev_{ts}")).alias("gap_days"))


def patched_links(linked: DataFrame, batch: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The links that a batch of appointments makes or changes.

    ``linked`` is the stored table of :func:`links`; ``batch`` has its first
    three columns.  Of the stored table only the batch's entities are read (a semi
    join; none of a partition without them where the table is laid out by entity).
    Rows are told apart by entity, date and tiebreak: an appointment that is
    stored already changes nothing, so a batch may be sent again.
    """
    entity, ts, tiebreak = linked.columns[:3]
    key = [entity, ts, tiebreak]
    (stored_flag,) = fresh(["stored"], linked.columns)
    new = batch.select(*[col(c) for c in key]).distinct()
    e = "_entity"
    affected = linked.join(new.select(col(entity).alias(e)).distinct(), col(entity).eqNullSafe(F.col(e)), "left_semi")
    # One row per appointment: the stored one, if there is one.
    rows = (affected.select(*[col(c) for c in key], F.lit(True).alias(stored_flag))
            .unionByName(new.withColumn(stored_flag, F.lit(False)))
            .groupBy(*[col(c) for c in key]).agg(F.max(stored_flag).alias(stored_flag)))
    again = links(rows, entity, ts, tiebreak, hot_rows)
    before = affected.select(*[col(c).alias(f"_{i}") for i, c in enumerate(linked.columns)])
    same = [col(c).eqNullSafe(F.col(f"_{i}")) for i, c in enumerate(linked.columns)]
    match = same[0]
    for s in same[1:]:
        match = match & s
    return again.join(before, match, "left_anti")


def apply_links(linked: DataFrame, patch: DataFrame) -> DataFrame:
    """The stored links with a patch in place."""
    key = linked.columns[:3]
    other = patch.select(*[col(c).alias(f"_{i}") for i, c in enumerate(key)])
    match = F.lit(True)
    for i, c in enumerate(key):
        match = match & col(c).eqNullSafe(F.col(f"_{i}"))
    return linked.join(other, match, "left_anti").unionByName(patch)
