"""Column names: quoting any name, and names that an input does not have."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """``name`` as one identifier, whatever dots, spaces or backticks it holds."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """The column of exactly that name (a dot is no field access)."""
    return F.col(quoted(name))


def fresh(wanted: Iterable[str], taken: Iterable[str]) -> list[str]:
    """The wanted names, each with underscores until it clashes with no taken
    one (Spark compares names without case)."""
    used = {t.lower() for t in taken}
    out = []
    for name in wanted:
        while name.lower() in used:
            name = "_" + name
        used.add(name.lower())
        out.append(name)
    return out
