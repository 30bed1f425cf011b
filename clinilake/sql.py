"""SQL form of the operators: temp views (S13) and ``.sql`` files."""

from __future__ import annotations

from importlib import resources
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def register(dfs: dict[str, DataFrame]) -> None:
    """Register each DataFrame as a session temp view under its key."""
    for name, df in dfs.items():
        df.createOrReplaceTempView(name)


def read_text(path: str | Path) -> str:
    """Read a single SQL statement; one trailing ``;`` is dropped."""
    text = Path(path).read_text(encoding="utf-8").strip()
    return text[:-1].rstrip() if text.endswith(";") else text


def bundled(name: str) -> str:
    """Text of a statement shipped in ``clinilake/plans/sql``."""
    text = resources.files("clinilake.plans").joinpath("sql", f"{name}.sql").read_text("utf-8")
    text = text.strip()
    return text[:-1].rstrip() if text.endswith(";") else text


def run_file(spark: SparkSession, path: str | Path,
             args: dict[str, Any] | None = None) -> DataFrame:
    """Run one statement from a file, with optional named parameters."""
    return spark.sql(read_text(path), args=args)


def run_bundled(spark: SparkSession, name: str,
                args: dict[str, Any] | None = None) -> DataFrame:
    return spark.sql(bundled(name), args=args)
