"""Helpers shared by the text operators: stored tables, let-binding, words."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinilake.names import col
from clinilake.session import checkpoint_dir

#: ASCII white space: tab to carriage return, and the space.
SPACE = "\t\n\x0b\x0c\r "
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage like ``checkpoint()``, in compressed columns: lost
    executors read the files again, and each later use scans only the columns
    it needs.  The folder is new for each call.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/clinilake-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_row(df: DataFrame) -> list[Column]:
    """All columns, whatever signs their names hold."""
    return [col(c) for c in df.columns]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` bound once.

    A plain Python variable would repeat the expression, inside lambdas once
    per element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """Maximal runs of other characters than ASCII white space."""
    return F.array_remove(F.split(F.translate(text, SPACE, " " * len(SPACE)), " "), "")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; every other character stays as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def literal_rows(spark: SparkSession, rows: list[tuple], names: tuple[str, ...]) -> DataFrame:
    """A small table of constants, without Python rows behind it."""
    return spark.range(1).select(F.inline(F.array(*[
        F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row, strict=True)]) for row in rows])))
