"""A natural key checked batch by batch (A1, A3).

Grouping the whole table for every load costs more with each load.  The ledger
keeps one row per key and batch: a 128-bit print of the key, never the key
itself, and how often the batch has it.  It is partitioned by a bucket of the
print, so a batch reads and rewrites the buckets of its own keys only, and a
batch that is loaded again replaces its own rows.

Null keys are keys like any other (two rows with equal nulls repeat), as in
:func:`clinilake.operators.quality.duplicate_keys`.  Two different keys have
one print with a chance of about n**2 / 2**129: below 10**-16 for 10**11 keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinilake import sinks
from clinilake.names import col, fresh
from clinilake.operators.quality import COUNT_COL

SCHEMA = "bucket int, print binary, batch string, n long"


def print_of(keys: Sequence[str], types: dict[str, str]) -> Column:
    """The key's print: MD5 of its values' texts, each with its length; null is told apart from any text."""
    parts = []
    for k in keys:
        text = F.date_format(col(k), "yyyy-MM-dd HH:mm:ss.SSSSSS") if types[k].startswith("timestamp") else \
            F.base64(col(k)) if types[k] == "binary" else col(k).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.md5(F.concat(*parts).cast("binary")))


def _printed(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return df.withColumn(name, print_of(keys, dict(df.dtypes)))


def _prints(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """Each row's (bucket, print)."""
    rows = df.select(print_of(keys, dict(df.dtypes)).alias("print"))
    return rows.select(F.pmod(F.xxhash64("print"), F.lit(buckets)).cast("int").alias("bucket"), "print")


def _touched(prints: DataFrame) -> DataFrame:
    """The buckets of a batch.  They are few whatever the batch's size: broadcast, so
    that the ledger's rows are not dealt by bucket, with a task for each."""
    return F.broadcast(prints.select("bucket").distinct())


def entries(df: DataFrame, keys: Sequence[str], batch: str, buckets: int) -> DataFrame:
    """The ledger's rows of one batch: (bucket, print, batch, n)."""
    counted = _prints(df, keys, buckets).groupBy("bucket", "print").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("bucket", "print", F.lit(batch).alias("batch"), "n")


def load(df: DataFrame, path: str, keys: Sequence[str], batch: str, buckets: int = 256) -> None:
    """Enter a batch.  ``buckets`` must be the same for all loads of a ledger:
    about the ledger's expected size / 256 MB.

    The batch's keys are counted together with its own stored rows, in one hash
    aggregate; the other batches' rows of its buckets are copied.  Files take
    their place as in :func:`clinilake.sinks.upsert_partitions`.
    """
    old = _stored(df.sparkSession, path)
    if old is None:
        rows = entries(df, keys, batch, buckets)
    else:
        new = _prints(df, keys, buckets)
        old = old.join(_touched(new), "bucket", "left_semi")
        own = F.col("batch").eqNullSafe(F.lit(batch))
        both = new.select("bucket", "print", F.lit(1).alias("sent"), F.lit(None).cast("long").alias("stored")).unionByName(
            old.where(own).select("bucket", "print", F.lit(None).cast("int").alias("sent"), F.col("n").alias("stored")))
        counted = both.groupBy("bucket", "print").agg(
            F.coalesce(F.nullif(F.count("sent"), F.lit(0)), F.max("stored")).alias("n"))
        rows = counted.select("bucket", "print", F.lit(batch).alias("batch"), "n").unionByName(
            old.where(~own).select("bucket", "print", "batch", "n"))
    sinks.replace_partitions(rows, path, ["bucket"])


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(SCHEMA).parquet(path).select("bucket", "print", "batch", "n")
    except AnalysisException as absent:
        if absent.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read(spark: SparkSession, path: str) -> DataFrame:
    """The ledger; empty before the first load."""
    stored = _stored(spark, path)
    return spark.createDataFrame([], SCHEMA) if stored is None else stored


def duplicates(df: DataFrame, path: str, keys: Sequence[str], buckets: int = 256,
               count_col: str = COUNT_COL) -> DataFrame:
    """The keys of a loaded batch that repeat, within it or with any batch: keys and count over all.

    Reads the buckets of the batch's keys (dynamic partition pruning).
    """
    p, seen, n = fresh(["print", "seen", "n"], df.columns)
    mine = _printed(df.select(*[col(k) for k in keys]).distinct(), keys, p)
    known = read(df.sparkSession, path)
    counts = known.join(_touched(_prints(df, keys, buckets)), "bucket", "left_semi").groupBy(F.col("print").alias(seen)).agg(
        F.sum("n").alias(n)).where(F.col(n) > 1)
    return mine.join(counts, F.col(p) == F.col(seen)).select(*[col(k) for k in keys], F.col(n).alias(count_col))


def verdict(ledger: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    """The row of :func:`clinilake.operators.quality.key_verdict` over all batches entered."""
    groups = ledger.groupBy("print").agg(F.sum("n").alias("n")).where("n > 1")
    return groups.agg(
        F.lit(table).alias("table_name"), F.lit(",".join(keys)).alias("key_columns"),
        F.count(F.lit(1)).alias("dup_groups"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("dup_rows"),
        (F.count(F.lit(1)) == 0).alias("is_unique"))
