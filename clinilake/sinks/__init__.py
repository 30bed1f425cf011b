"""Writers: parquet tables (S6-S8), JDBC (S9), managed tables."""

from __future__ import annotations

import logging
import posixpath
from urllib.parse import urlparse
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinilake.names import col

log = logging.getLogger(__name__)


def _layout(df: DataFrame, files: int | None, partition_by: Sequence[str] | None,
            sort_by: Sequence[str] | None) -> DataFrame:
    """Shape output files.

    ``files=None`` leaves partitioning to the plan (AQE already coalesces small
    shuffle partitions); a fixed ``files`` count is a round-robin shuffle, so it
    is opt-in.  With ``partition_by`` the rows are clustered by the directory
    columns so each task writes few directories, through a ``rebalance`` hint:
    AQE splits a directory value holding a large share of the rows over
    several tasks (several files) and merges small ones, instead of one task
    writing a whole hot directory.  An explicit ``files`` count fixes the
    number of partitions instead.
    """
    if partition_by:
        df = df.repartition(files, *partition_by) if files else df.hint("rebalance", *partition_by)
    elif files:
        df = df.repartition(files)
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    return df


def _location(uri: str) -> str:
    u = urlparse(uri)
    path = posixpath.normpath(u.path or "/")
    return path if u.scheme in ("", "file") else f"{u.scheme}://{u.netloc}{path}"


def _same_location(a: str, b: str) -> bool:
    """``a`` is ``b`` or lies under it (local paths and ``file:`` URIs alike)."""
    a, b = _location(a), _location(b)
    return a == b or a.startswith(b.rstrip("/") + "/")


def write_table(df: DataFrame, path: str, mode: str = "overwrite", *,
                files: int | None = None, partition_by: Sequence[str] | None = None,
                sort_by: Sequence[str] | None = None, check_inputs: bool = True) -> None:
    """Parquet sink.

    Overwriting a path that the same plan reads would delete its input
    mid-job, so that is refused up front.  The check lists the plan's input
    files on the driver (the list Spark built when the sources were read);
    for inputs of very many files whose zone is known to differ, pass
    ``check_inputs=False``.
    """
    if (mode == "overwrite" and check_inputs
            and any(_same_location(f, path) for f in df.inputFiles())):
        raise ValueError(f"refusing to overwrite {path}: the DataFrame reads from it")
    log.info("writing parquet %s (mode=%s)", path, mode)
    writer = _layout(df, files, partition_by, sort_by).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def upsert_partitions(batch: DataFrame, path: str, key: Sequence[str], partition_by: Sequence[str],
                      newest: Sequence[str] = (), sort_by: Sequence[str] | None = None) -> None:
    """Merge ``batch`` into a partitioned parquet table, rewriting only the partitions it touches.

    Of the rows of one ``key`` the batch's replaces the stored one; within the
    batch the row with the largest ``newest`` columns (then of all columns) stays.
    ``key`` must hold the partition columns, so that no key has a row in another
    partition, and these must not be null.  Other partitions are neither read
    (dynamic partition pruning) nor written (dynamic partition overwrite): new
    files are written beside the old ones and take their place when all tasks have
    ended.  Loading a batch again gives the same rows, so a load that was cut off
    may simply be repeated.
    """
    missing = set(partition_by) - set(key)
    if missing or not partition_by:
        raise ValueError(f"the key must hold the partition columns {sorted(missing) or list(partition_by)}")
    spark = batch.sparkSession
    parts = [col(c) for c in partition_by]
    given = batch.select(*[F.when(col(c).isNull(), F.raise_error(F.lit(f"{c} is null")).cast(batch.schema[c].dataType))
                           .otherwise(col(c)).alias(c) if c in partition_by else col(c) for c in batch.columns])
    whole = F.struct(*[col(c) for c in batch.columns])
    order = F.struct(*[col(c) for c in [*newest, *batch.columns]]) if newest else whole
    latest = given.groupBy(*[col(c) for c in key]).agg(F.max_by(whole, order).alias("_row")).select("_row.*")
    try:
        old = spark.read.parquet(path)
    except AnalysisException as absent:
        if absent.getCondition() != "PATH_NOT_FOUND":
            raise
        merged = latest
    else:
        touched = F.broadcast(given.select(*parts).distinct())  # few, however large the batch
        same = [(col(c), f"_{i}") for i, c in enumerate(key)]
        mine = latest.select(*[c.alias(name) for c, name in same])
        match = F.lit(True)
        for c, name in same:
            match = match & c.eqNullSafe(F.col(name))
        old = old.select(*[col(c) for c in batch.columns]).join(touched, list(partition_by), "left_semi")
        merged = old.join(mine, match, "left_anti").select(*[col(c) for c in batch.columns]).unionByName(latest)
    replace_partitions(merged, path, partition_by, sort_by)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str],
                       sort_by: Sequence[str] | None = None) -> None:
    """Write the partitions that ``df`` has rows of in place of the stored ones; the others stay.

    ``df`` may read the same path: files are exchanged when all tasks have ended.
    """
    log.info("replacing partitions of %s", path)
    (_layout(df, None, partition_by, sort_by).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path))


def save_table(df: DataFrame, name: str, mode: str = "overwrite", *, fmt: str = "parquet",
               partition_by: Sequence[str] | None = None,
               bucket_by: tuple[int, Sequence[str]] | None = None,
               files: int | None = None) -> None:
    """Managed catalog table (``saveAsTable``).

    ``bucket_by=(n, cols)`` stores the table bucketed so later joins and
    aggregations on ``cols`` between tables bucketed alike skip the shuffle.
    """
    writer = _layout(df, files, partition_by, None).write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        n, cols = bucket_by
        writer = writer.bucketBy(n, *cols).sortBy(*cols)
    writer.saveAsTable(name)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite", *,
               num_partitions: int | None = None, batchsize: int = 10_000,
               **options: str) -> None:
    """JDBC sink.  Each partition opens one connection and writes in batches;
    ``num_partitions`` caps concurrent connections with a shuffle, so that the
    stage before it keeps its own number of tasks."""
    out = df.repartition(num_partitions) if num_partitions else df
    writer = (out.write.format("jdbc").option("url", url).option("dbtable", table)
              .option("batchsize", str(batchsize)).mode(mode))
    for key, value in options.items():
        writer = writer.option(key, value)
    writer.save()


def write_zone(df: DataFrame, lake, zone: str, name: str, mode: str = "overwrite", *,
               files: int | None = None, partition_by: Sequence[str] | None = None,
               check_inputs: bool = False, audit=None) -> None:
    """Write a lake table: a catalog table in the zone's database when the lake
    uses tables (Spark itself refuses to overwrite a table the plan reads), a
    snapshot when it uses those (``audit`` makes a report of the written rows,
    which must be clean before they are published; see
    :mod:`clinilake.snapshots`), else parquet files at the zone path.

    The library's jobs write one table and read others, so the list of input
    files is not brought to the driver unless ``check_inputs`` asks for it.
    """
    if lake.tables:
        lake.ensure_database(df.sparkSession, zone)
        save_table(df, lake.table(zone, name), mode, partition_by=partition_by, files=files)
    elif lake.snapshots:
        from clinilake import snapshots
        path = lake.path(zone, name)
        if mode == "append" and snapshots.current(df.sparkSession, path)[0]:
            df = snapshots.read(df.sparkSession, path).unionByName(df)
        snapshots.write_audited(df, path, audit, files=files, partition_by=partition_by)
    else:
        write_table(df, lake.path(zone, name), mode, files=files, partition_by=partition_by,
                    check_inputs=check_inputs)
