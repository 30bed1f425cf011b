"""Session creation (C5), reuse of expensive DataFrames (C1), checkpoints."""

from __future__ import annotations

import contextlib
import logging
import tempfile
from collections.abc import Iterator

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

# Settings a job on this library wants whatever the cluster size.  Shuffle
# partition counts and broadcast thresholds are left to the cluster's own
# configuration; AQE then coalesces small partitions and splits skewed ones.
DEFAULT_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Checkpoint files of the ordered operators are removed once their
    # DataFrame is garbage collected, instead of piling up in the shared folder.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get(app_name: str = "clinilake", conf: dict[str, str] | None = None,
        master: str | None = None) -> SparkSession:
    """Return the active session or build one.

    The master is never hard-coded: ``spark-submit`` or the caller decides.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextlib.contextmanager
def reused(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK,
           fill: bool = False) -> Iterator[DataFrame]:
    """Persist ``df`` for the duration of a block, then always unpersist.

    ``fill=True`` runs one count first, so the cache is complete before the
    block's first real use (otherwise the first action fills it).  Cached
    blocks are recomputed from lineage if an executor is lost, so this is safe
    but not a lineage cut; use :func:`checkpointed` for that.
    """
    df.persist(level)
    try:
        if fill:
            df.count()
        yield df
    finally:
        df.unpersist()


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    When the cluster names none, ``fallback`` is used; without a fallback a
    fresh temporary folder is taken, but only in local mode, where every
    executor runs on this machine.  On a cluster that is an error: a
    machine-local folder would not be visible to other executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if fallback is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder")
            fallback = tempfile.mkdtemp(prefix="clinilake-checkpoints-")
        current = fallback
        spark.conf.set("spark.checkpoint.dir", current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def checkpointed(df: DataFrame, fallback_dir: str | None = None) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (cuts lineage).

    The rows are computed once and read back from storage by every later use,
    so two branches of one plan see the same rows, and a lost executor does
    not recompute them.
    """
    checkpoint_dir(df.sparkSession, fallback_dir)
    return df.checkpoint(eager=True)
