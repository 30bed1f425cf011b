"""Readers: parquet tables (S1, S2), JDBC (S10), raw landing (S11), workbooks (S3)."""

from __future__ import annotations

import logging
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinilake.lake import Lake
from clinilake.sources.rescue import land_lines, parse_lines, rebuilt  # noqa: F401
from clinilake.sources.workbooks import read_workbooks  # noqa: F401

log = logging.getLogger(__name__)


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Lazy parquet scan of one table directory or file.

    With ``schema`` (a ``StructType`` or DDL string) the footer is not read to
    infer one; columns missing from the files read as null.
    """
    log.info("reading parquet %s", path)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_tables(spark: SparkSession, root: str | Lake, names: Iterable[str],
                zone: str = "silver", suffix: str = "") -> dict[str, DataFrame]:
    """Map each table name to a lazy scan of ``root/name`` (or a lake zone).

    Only footers are touched now; columns and row groups are pruned later by
    whatever the query selects and filters.
    """
    out = {}
    for name in names:
        if isinstance(root, Lake):
            out[name] = read_zone(spark, root, zone, name)
        else:
            out[name] = read_table(spark, f"{root.rstrip('/')}/{name}{suffix}")
    return out


def read_zone(spark: SparkSession, lake: Lake, zone: str, name: str) -> DataFrame:
    """A lake table: the catalog table ``lake.table(zone, name)`` when the lake
    uses tables, the published version at ``lake.path(zone, name)`` when it uses
    snapshots, else the parquet files there."""
    if lake.tables:
        return spark.table(lake.table(zone, name))
    if lake.snapshots:
        from clinilake import snapshots
        return snapshots.read(spark, lake.path(zone, name))
    return read_table(spark, lake.path(zone, name))


def read_jdbc(spark: SparkSession, url: str, table: str, *,
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None,
              fetchsize: int = 10_000, **options: str) -> DataFrame:
    """Parallel JDBC ingest.

    Without a partition column a JDBC read is a single task; with one, Spark
    issues ``num_partitions`` range queries on it.  Credentials come from the
    caller (``user=``, ``password=``), never from this library.
    """
    reader = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
              .option("fetchsize", str(fetchsize)))
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound))
                  .option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions)))
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load()


def land_raw(spark: SparkSession, fmt: str, path: str, *, schema=None,
             **options: str) -> DataFrame:
    """Bronze landing: a faithful copy of a source, at most a format change.

    Adds ``_source_file`` and ``_ingested_at`` for lineage; values are not
    cleaned.  Write the result with :func:`clinilake.sinks.write_table`.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    for key, value in options.items():
        reader = reader.option(key, value)
    df = reader.load(path)
    return df.select("*", F.col("_metadata.file_path").alias("_source_file"),
                     F.current_timestamp().alias("_ingested_at"))


def literal_table(spark: SparkSession, rows: list[tuple], schema) -> DataFrame:
    """A small fixed table (a catalogue) as a ``LocalRelation``.

    Built from SQL ``VALUES`` with bound parameters, so Spark knows its exact
    size: it is broadcast without a job and never shuffled.  ``schema`` is a
    ``StructType`` or a DDL string.
    """
    from pyspark.sql.types import StructType
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    names = [f.name for f in schema]
    args, tuples = {}, []
    for i, row in enumerate(rows):
        marks = []
        for j, value in enumerate(row):
            args[f"p{i}_{j}"] = value
            marks.append(f":p{i}_{j}")
        tuples.append("(" + ", ".join(marks) + ")")
    cols = ", ".join(f"_c{j}" for j in range(len(names)))
    raw = spark.sql(f"select * from values {', '.join(tuples)} as t({cols})", args=args)
    return raw.select([F.col(f"_c{j}").cast(f.dataType).alias(f.name) for j, f in enumerate(schema)])
