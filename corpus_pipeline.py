"""The corpus pipeline: stages over ``documents``, each written and read again.

A stage takes (spark, docs, sf_dir) and returns a DataFrame.  All but the last
return the columns of ``documents``; what a stage decides takes effect in its
rows or texts, and the order of the mix in the last one's position column.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clinilake.llm import bpe, mixing, neardup, pii, quality
from clinilake.llm.common import stored
from clinilake.llm.queries import WEIGHTS, vocabulary_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the certified cutoffs reject go."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the smallest doc_id."""
    return neardup.drop_copies(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by marks; n_chars follows."""
    return pii.redact(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix: the rows' order, so the files'."""
    return mixing.mix(docs, WEIGHTS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text: doc_id, position (its place in the mix), n_tokens, ids,
    and the text they decode to, sorted by position.

    The mix keeps every row, so the schedule of its rows is that of the mix
    itself.  Each text is encoded once: the ids are stored with their places, and
    what is sorted and decoded comes from there.
    """
    keyed = docs.withColumn("row_key", mixing.row_key(docs))
    ids = bpe.encode(keyed.select("doc_id", "text", "row_key"), vocabulary_path(), carried=("row_key",), packed=True)
    placed = stored(mixing.with_positions(ids, "row_key", docs, WEIGHTS).drop("row_key"), "ids")
    return bpe.decode(placed.orderBy("position"), vocabulary_path(), carried=("position",), packed=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixed_sources", mixed_sources),
    ("encoded", encoded),
]

#: Components, a trained field and a tokenizer have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each one's rows are Parquet before the next reads them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
