"""Incremental bronze landing with Structured Streaming.

The health lake's processing is all batch; its documented bronze zone is a
faithful copy of each source with at most a format change.  When source
files keep arriving, the same copy is a file-source stream: every new file
is landed once, exactly-once by the checkpoint, with the lineage columns of
:func:`clinilake.sources.land_raw`.  ``availableNow`` processes what is
there and stops, so it runs as a scheduled batch job.

A file stream knows files by their names.  :func:`land_files` knows them by
their content: a file that is sent again, renamed or not, lands once.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def _checkpoint(spark: SparkSession, name: str, checkpoint: str | None) -> str:
    if checkpoint:
        return checkpoint
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("pass checkpoint= or set spark.checkpoint.dir to a shared folder")
    return f"{base.rstrip('/')}/landing/{name}"


def land_stream(spark: SparkSession, fmt: str, source: str, schema: StructType, target: str,
                name: str, checkpoint: str | None = None, partition_by: list[str] | None = None,
                max_files_per_trigger: int | None = None, **options: str) -> StreamingQuery:
    """Start a stream that copies new ``fmt`` files under ``source`` to parquet.

    A file stream needs its ``schema`` up front (no inference on a stream).
    Without ``checkpoint`` the progress lives in
    ``<spark.checkpoint.dir>/landing/<name>``: the same name resumes where
    the last run stopped, a new name starts over.
    Returns the started query; call ``awaitTermination()`` to wait for it.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    for key, value in options.items():
        reader = reader.option(key, value)
    rows = reader.load(source).select(
        "*", F.col("_metadata.file_path").alias("_source_file"),
        F.current_timestamp().alias("_ingested_at"))
    writer = (rows.writeStream.format("parquet").option("path", target)
              .option("checkpointLocation", _checkpoint(spark, name, checkpoint))
              .queryName(name).trigger(availableNow=True))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start()


LANDED = "digest string, path string, modified_at timestamp, length long, content binary, batch long"


def landed_files(spark: SparkSession, target: str) -> DataFrame:
    """What :func:`land_files` has landed: digest, path, modified_at, length, content, batch."""
    columns = [c.split(" ")[0] for c in LANDED.split(", ")]
    try:
        return spark.read.schema(LANDED).parquet(target).select(*columns)
    except AnalysisException as absent:
        if absent.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LANDED)


def land_files(spark: SparkSession, source: str, target: str, name: str, checkpoint: str | None = None,
               pattern: str = "*", max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start a stream that lands each new *content* under ``source`` once, as it is.

    Every micro-batch is digested (SHA-256) in Spark, files of one content are
    reduced to the first path, and digests that an earlier batch has landed go (an
    anti join that reads the digest column alone).  A batch writes its own folder
    ``batch=<id>`` of ``target`` and compares itself with the other folders only,
    so one that is run again after a failure lands the same files.  A file must
    fit a row (2 GB); empty files, which Spark never lists, do not land.  Returns
    the started query.
    """
    reader = (spark.readStream.format("binaryFile").option("pathGlobFilter", pattern)
              .schema("path string, modificationTime timestamp, length long, content binary"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))

    def land(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        digest = F.sha2("content", 256).alias("digest")
        known = landed_files(own, target).where(F.col("batch") != batch_id).select("digest").distinct()
        digests = batch.select(digest, "path").groupBy("digest").agg(F.min("path").alias("path")).join(
            known, "digest", "left_anti")
        rows = batch.select(digest, "path", F.col("modificationTime").alias("modified_at"), "length", "content")
        rows.join(digests, ["digest", "path"]).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return (reader.load(source).writeStream.foreachBatch(land)
            .option("checkpointLocation", _checkpoint(spark, name, checkpoint))
            .queryName(name).trigger(availableNow=True).start())
