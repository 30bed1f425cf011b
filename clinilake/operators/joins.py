"""Star / snowflake join.

A fact table is joined to dimensions by equality keys.  Each input gets its
own alias, so a role-playing dimension (the same table twice) or a dimension
derived from the fact stays unambiguous; columns are selected as
``"alias.column"``.

Join strategy per dimension:

* ``broadcast=None`` (default) - Spark decides: a static size estimate against
  ``spark.sql.autoBroadcastJoinThreshold`` and, with AQE, the exact size of a
  finished shuffle stage.  Large dimensions become sort-merge joins; AQE splits
  skewed fact partitions.
* ``broadcast=True`` - broadcast only after :func:`fits_broadcast` proves the
  projected dimension is within ``max_rows`` and ``max_bytes``; otherwise fall
  back to Spark's choice and log it.
* ``broadcast=False`` - never broadcast (sort-merge hint).

Snowflake hops (a dimension keyed from another dimension) are joined after
their parent, on the joined rows.  With ``prejoin=True`` a hop is joined into
its parent dimension first (when that keeps the semantics): worth it only
when both are too large to broadcast, since it saves one shuffle of the fact.
It is not the default because Spark estimates a join's size as the product of
its inputs, so a pre-joined dimension is rarely broadcast even when tiny.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinilake.names import col, quoted

log = logging.getLogger(__name__)

DEFAULT_MAX_ROWS = 200_000
DEFAULT_MAX_BYTES = 64 * 1024 * 1024


@dataclass
class Dim:
    """One dimension of a star join.

    ``on`` pairs ``(parent_column, dim_column)``; the parent is the fact unless
    ``parent`` names another dimension's alias (a snowflake hop).
    ``complete=True`` asserts that every parent row finds exactly one row
    here (keys unique, none missing, none null); such a dimension is left out
    of the join when nothing selected comes from it, since joining it could
    neither drop nor repeat rows.
    """

    df: DataFrame
    alias: str
    on: Sequence[tuple[str, str]]
    parent: str | None = None
    how: str = "inner"
    broadcast: bool | None = None
    max_rows: int = DEFAULT_MAX_ROWS
    max_bytes: int = DEFAULT_MAX_BYTES
    prejoin: bool = False
    complete: bool = False


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of one row: 8 per fixed-width field, the UTF-8 length of text and
    binary values, and the JSON text length of nested values."""
    parts = []
    for f in df.schema:
        c = col(f.name)
        kind = f.dataType.typeName()
        if kind in ("string", "binary"):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)) + F.lit(8))
        elif kind in ("array", "map", "struct"):
            parts.append(F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)) + F.lit(8))
        else:
            parts.append(F.lit(8))
    return sum(parts[1:], parts[0]) if parts else F.lit(0)


def fits_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS,
                   max_bytes: int = DEFAULT_MAX_BYTES) -> bool:
    """Prove ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes.

    At most ``max_rows + 1`` rows of a few bytes meet in one task, which counts
    them and sums their sizes; one row comes to the driver.
    """
    found = df.select(_row_bytes(df).alias("b")).limit(max_rows + 1).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("b"), F.lit(0)).alias("size")).first()
    return found["n"] <= max_rows and found["size"] <= max_bytes


def _hinted(dim: Dim, df: DataFrame) -> DataFrame:
    if dim.broadcast is True:
        if fits_broadcast(df, dim.max_rows, dim.max_bytes):
            return F.broadcast(df)
        log.warning("dimension %s exceeds the broadcast bound; leaving the join "
                    "strategy to Spark", dim.alias)
        return df
    if dim.broadcast is False:
        return df.hint("merge")
    return df


def _condition(left_alias: str, right_alias: str, on: Sequence[tuple[str, str]]) -> Column:
    conds = [F.col(f"{left_alias}.{quoted(lc)}") == F.col(f"{right_alias}.{quoted(rc)}") for lc, rc in on]
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def _absorb(dim: Dim, children: dict[str, list[Dim]]) -> DataFrame:
    """The dimension with its snowflake children joined in (aliases kept)."""
    out = dim.df.alias(dim.alias)
    for child in children[dim.alias]:
        out = out.join(_hinted(child, _absorb(child, children)),
                       _condition(dim.alias, child.alias, child.on), child.how)
    return out


def _family(dim: Dim, children: dict[str, list[Dim]]) -> set[str]:
    """The aliases of a dimension and of all that are joined into it."""
    return {dim.alias}.union(*(_family(c, children) for c in children[dim.alias]))


_QUALIFIED = re.compile(r"(?<![\w.`])`?([A-Za-z_]\w*)`?\.")


def _referenced_aliases(select: Sequence[Column | str]) -> set[str]:
    """Aliases named as ``alias.column`` in the select list (strings, or the
    SQL text of Column expressions)."""
    out = set()
    for item in select:
        out.update(_QUALIFIED.findall(item if isinstance(item, str) else str(item)))
    return out


def star_join(fact: DataFrame, dims: Sequence[Dim], select: Sequence[Column | str] | None = None,
              fact_alias: str = "f", validate: bool = False) -> DataFrame:
    """Join ``fact`` to ``dims`` and project ``select`` (default: all columns).

    Inner joins drop fact rows whose key is null or unmatched, as a SQL star
    join does; use ``how="left"`` on a dimension to keep them and
    :func:`clinilake.operators.quality.orphans` to count what is lost.

    A dimension with a repeated key multiplies fact rows.  ``validate=True``
    checks every dimension key first (one aggregation per dimension, stopping
    at the first repeat) and raises ``ValueError`` naming the dimension.
    """
    if validate:
        from clinilake.operators.quality import duplicate_keys
        for d in dims:
            if not duplicate_keys(d.df, [dc for _, dc in d.on]).isEmpty():
                raise ValueError(f"dimension {d.alias} repeats its key {[dc for _, dc in d.on]}")
    aliases = {fact_alias} | {d.alias for d in dims}
    if len(aliases) != len(dims) + 1:
        raise ValueError("every dimension needs its own alias, distinct from the fact's")
    if select is not None:
        needed = _referenced_aliases(select) | {d.alias for d in dims if not d.complete}
        # A dimension is needed if selected from, not known complete, or if a
        # needed one hangs off it.
        changed = True
        while changed:
            changed = False
            for d in dims:
                if d.alias in needed and d.parent and d.parent not in needed:
                    needed.add(d.parent)
                    changed = True
        dims = [d for d in dims if not (d.complete and d.alias not in needed)]
    by_alias = {d.alias: d for d in dims}
    children: dict[str, list[Dim]] = {d.alias: [] for d in dims}
    top: list[Dim] = []
    for d in dims:
        parent = by_alias.get(d.parent) if d.parent else None
        if d.parent and parent is None:
            raise ValueError(f"dimension {d.alias} names unknown parent {d.parent}")
        # Pre-joining a child into its parent is the same as joining it after
        # the parent unless the parent is outer and the child inner.
        if parent is not None and d.prejoin and not (parent.how != "inner" and d.how == "inner"):
            children[parent.alias].append(d)
        else:
            top.append(d)
    out = fact.alias(fact_alias)
    joined = {fact_alias}
    for d in top:
        left = d.parent or fact_alias
        if left not in joined:
            raise ValueError(f"dimension {d.alias} must come after its parent {left}")
        joined |= _family(d, children)
        out = out.join(_hinted(d, _absorb(d, children)), _condition(left, d.alias, d.on), d.how)
    if select is None:
        return out
    return out.select(*[F.col(c) if isinstance(c, str) else c for c in select])
