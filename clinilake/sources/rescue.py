"""Landing records so that nothing is lost.

A typed read turns what does not fit its schema into nulls.  Here each line of
JSON or CSV is parsed by the schema, and what the typed columns cannot give
back stays beside them as text:

``_rescued``  the fields that the schema does not name, or whose value does not
              have the declared type, by name (null if there is none)
``_raw``      the whole line, if writing the typed columns out again would not
              give that very line (null if it would)

:func:`rebuilt` gives every line back, character by character.  All of it is
expressions over one text column, so it runs on files and on streams alike.

Records are single lines.  Null and empty lines are records too; of a field
that repeats in one line, ``_rescued`` has the last value and ``_raw`` all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clinilake.names import col, fresh, quoted

RESCUED, RAW = "_rescued", "_raw"
FORMATS = ("json", "csv")


def _parsers(fmt: str, line: Column, schema: StructType, options: dict[str, str]) -> tuple[Column, Column]:
    """The typed struct, and the line's fields as texts by name."""
    if fmt == "json":
        fields = F.from_json(line, "map<string,string>", options)
        # Field by field: one that does not fit must not cost its neighbours.
        typed = F.struct(*[F.get(F.array(F.from_json(line, StructType([f]), options)), F.lit(0))[f.name].alias(f.name)
                           for f in schema])
        return typed, fields
    texts = F.from_csv(line, ", ".join(f"{quoted(f.name)} string" for f in schema), options)
    fields = F.map_from_arrays(F.array(*[F.lit(f.name) for f in schema]), F.array(*[texts[f.name] for f in schema]))
    typed = F.struct(*[texts[f.name].try_cast(f.dataType).alias(f.name) for f in schema])
    return typed, fields


def _written(fmt: str, typed: Column, options: dict[str, str]) -> Column:
    return F.to_json(typed, options) if fmt == "json" else F.to_csv(typed, options)


def parse_lines(lines: DataFrame, fmt: str, schema: StructType | str, line: str = "value",
                options: dict[str, str] | None = None) -> DataFrame:
    """Replace the column ``line`` by the schema's columns, ``_rescued`` and ``_raw``.

    The other columns of ``lines`` stay behind them; they must not share the
    schema's names.
    """
    if fmt not in FORMATS:
        raise ValueError(f"fmt must be one of {FORMATS}")
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    clash = {f.name for f in schema} & (set(lines.columns) - {line} | {RESCUED, RAW})
    if clash:
        raise ValueError(f"columns in both the schema and the lines: {sorted(clash)}")
    options = dict(options or {})
    typed, fields, text = fresh(["typed", "fields", "text"], [*lines.columns, *schema.names])
    parsed, named = _parsers(fmt, F.col(text), schema, options)
    others = [col(c) for c in lines.columns if c != line]
    rows = lines.select(col(line).cast("string").alias(text), *others).withColumns({typed: parsed, fields: named})
    missing = F.map_from_arrays(
        F.array(*[F.lit(f.name) for f in schema]),
        F.array(*[F.col(f"{typed}.{quoted(f.name)}").isNull() for f in schema]))
    lost = F.map_filter(F.col(fields), lambda k, v: v.isNotNull() & F.coalesce(F.element_at(missing, k), F.lit(True)))
    # A line without any typed value stays whole: nothing else tells it from a null line.
    some = F.coalesce(*[F.col(f"{typed}.{quoted(f.name)}").cast("string") for f in schema]).isNotNull()
    same = some & F.coalesce(_written(fmt, F.col(typed), options) == F.col(text), F.lit(False))
    return rows.select(
        *[F.col(f"{typed}.{quoted(f.name)}").alias(f.name) for f in schema],
        F.when(F.size(lost) > 0, lost).alias(RESCUED), F.when(~same, F.col(text)).alias(RAW), *others)


def rebuilt(landed: DataFrame, fmt: str, schema: StructType | str, options: dict[str, str] | None = None) -> Column:
    """The line that each landed row came from (null lines come back as null)."""
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    some = F.coalesce(*[col(f.name).cast("string") for f in schema]).isNotNull()
    written = _written(fmt, F.struct(*[col(f.name) for f in schema]), dict(options or {}))
    return F.coalesce(F.col(RAW), F.when(some, written))


def land_lines(spark: SparkSession, fmt: str, path: str, schema: StructType | str, **options: str) -> DataFrame:
    """Bronze landing of JSON or CSV lines: typed columns, ``_rescued``, ``_raw``,
    ``_source_file`` and ``_ingested_at``."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("_source_file"), F.current_timestamp().alias("_ingested_at"))
    return parse_lines(lines, fmt, schema, options=options)
