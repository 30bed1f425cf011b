"""Tables published as snapshots: write, audit, then publish.

Overwriting a table in place shows readers a half-written table, and a check that
runs after the write comes too late.  Here a write is a new folder that nobody
reads yet; the checks run on what was written; and only then one small file
makes it the table's next version::

    <table>/snapshots/<id>/    rows of one write, never changed afterwards
    <table>/pointers/<n>-<id>/ one row: version, snapshot, batch, published_at

Readers take the snapshot of the highest version.  A failing check, a killed
write or a lost driver leaves a folder without a pointer and the old version in
place; a reader that has begun goes on with the files of its version.  A table
may be read while its next version is written from it.

One publisher at a time is assumed for each table.  Two that publish the same
version are told apart alike by every reader (the smaller snapshot id), and the
loser is told by :class:`StaleVersion` if its check sees the other.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinilake import sinks
from clinilake.operators import quality

POINTER = "version long, snapshot string, batch string, published_at timestamp"


class StaleVersion(ValueError):
    """The table has another version than the publisher expected."""


def versions(spark: SparkSession, path: str) -> DataFrame:
    """(version, snapshot, batch, published_at) of all published versions, one row each."""
    try:
        found = spark.read.schema(POINTER).option("recursiveFileLookup", "true").parquet(f"{path}/pointers")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.range(0).select(*[F.lit(None).cast(kind).alias(name) for name, kind in
                                        (c.split(" ") for c in POINTER.split(", "))])
    columns = [c for c in found.columns if c != "version"]
    return found.groupBy("version").agg(F.min_by(F.struct(*columns), "snapshot").alias("p")).select("version", "p.*")


def current(spark: SparkSession, path: str) -> tuple[int, str | None]:
    """(version, snapshot id) that readers see; (0, None) before the first publication."""
    row = versions(spark, path).agg(F.max(F.struct("version", "snapshot")).alias("p")).select("p.*").first()
    return (row.version, row.snapshot) if row and row.version is not None else (0, None)


def snapshot(spark: SparkSession, path: str, snapshot_id: str) -> DataFrame:
    """The rows of one write, published or not."""
    return spark.read.parquet(f"{path}/snapshots/{snapshot_id}")


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of the table's current version, or of an earlier one."""
    if version is None:
        _, chosen = current(spark, path)
    else:
        row = versions(spark, path).where(F.col("version") == version).select("snapshot").first()
        chosen = row.snapshot if row else None
    if chosen is None:
        raise FileNotFoundError(f"no published version{'' if version is None else f' {version}'} of {path}")
    return snapshot(spark, path, chosen)


def stage(df: DataFrame, path: str, *, files: int | None = None, partition_by: Sequence[str] | None = None,
          sort_by: Sequence[str] | None = None) -> str:
    """Write ``df`` beside the table's versions; nobody reads it yet.  Returns its id."""
    snapshot_id = uuid.uuid4().hex
    sinks.write_table(df, f"{path}/snapshots/{snapshot_id}", "error", files=files, partition_by=partition_by,
                      sort_by=sort_by)
    return snapshot_id


def publish(spark: SparkSession, path: str, snapshot_id: str, batch: str | None = None,
            expected: int | None = None) -> int:
    """Make a staged write the table's next version, and return that version.

    ``batch`` names what was loaded (see :func:`has_batch`).  With ``expected``
    nothing is published if the table has moved on from that version.
    """
    last, _ = current(spark, path)
    if expected is not None and last != expected:
        raise StaleVersion(f"{path} is at version {last}, not {expected}")
    pointer = spark.range(0, 1, 1, 1).select(
        F.lit(last + 1).cast("long").alias("version"), F.lit(snapshot_id).alias("snapshot"),
        F.lit(batch).cast("string").alias("batch"), F.current_timestamp().alias("published_at"))
    pointer.write.mode("error").parquet(f"{path}/pointers/{last + 1:012d}-{snapshot_id}")
    winner = versions(spark, path).where(F.col("version") == last + 1).select("snapshot").first()
    if winner.snapshot != snapshot_id:
        raise StaleVersion(f"another write became version {last + 1} of {path}")
    return last + 1


def has_batch(spark: SparkSession, path: str, batch: str) -> bool:
    """Whether a published version says that it loaded this batch."""
    return not versions(spark, path).where(F.col("batch") == batch).isEmpty()


Audit = Callable[[DataFrame], DataFrame]


def write_audited(df: DataFrame, path: str, audit: Audit | None = None, *, batch: str | None = None,
                  files: int | None = None, partition_by: Sequence[str] | None = None,
                  sort_by: Sequence[str] | None = None) -> int:
    """Write, audit, publish: returns the new version.

    ``audit`` makes a report of checks (:func:`clinilake.operators.quality.report`)
    of the *written* rows; a violation raises ``QualityError`` and the table stays
    at its version.
    """
    spark = df.sparkSession
    began, _ = current(spark, path)
    snapshot_id = stage(df, path, files=files, partition_by=partition_by, sort_by=sort_by)
    if audit is not None:
        quality.assert_clean(audit(snapshot(spark, path, snapshot_id)))
    return publish(spark, path, snapshot_id, batch, began)


def merge_batch(state: DataFrame, path: str, batch: str, merge: Callable[[DataFrame, DataFrame], DataFrame],
                audit: Audit | None = None) -> int:
    """Merge a batch's partial state into the published one, once for each batch.

    ``merge(old, new)`` makes the next state.  A batch that a version already
    names is not merged again, so a load may be repeated after any failure.
    Returns the version that holds the batch.
    """
    spark = state.sparkSession
    if has_batch(spark, path, batch):
        return versions(spark, path).where(F.col("batch") == batch).agg(F.min("version")).first()[0]
    version, old = current(spark, path)
    merged = merge(snapshot(spark, path, old), state) if version else state
    return write_audited(merged, path, audit, batch=batch)
