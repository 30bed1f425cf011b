"""Token counts: one exact histogram of encoded lengths answers every limit.

A scan encodes each whole text and keeps its length; documents are aggregated
by length.  Suffix sums over the histogram then give, for any context limit L,
the documents and tokens above it, the tokens that cutting at L keeps or loses,
and exact quantiles, without reading the texts again.

The histogram has a row for each distinct length.  Its running sums are made
in two levels (within ranges of lengths, then over the ranges), so that no
single task gets all of it.

Defined results: null and empty texts have length 0 and count as documents;
rows that repeat a doc_id each count; extra columns are ignored; an empty table
has an empty histogram, totals of 0 and null quantiles.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .vocabulary import vocabulary

#: Lengths of a range, for the two levels of sums.
RANGE = 1024
#: Rows of a batch that are taken at a time.
ROWS = 256
LIMITS = (128, 256, 512, 1024, 2048, 4096, 8192, 16384, 32768)
QUANTILES = (0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0)


def _lengths(path: str):
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = vocabulary(path).encode_one
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                sizes = [len(encode(t.as_py() or "")) for t in part.column("text")]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sizes, pa.int64())],
                                                 names=["doc_id", "n_tokens"])
    return measure


def encoded_lengths(documents: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens) of every row: the length of the whole text, encoded."""
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
                            ).mapInArrow(_lengths(path), "doc_id long, n_tokens long")


def histogram(lengths: DataFrame) -> DataFrame:
    """(n_tokens, docs): partial sums first, so a common length is no hot key."""
    return lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("docs"))


def suffix_sums(hist: DataFrame) -> DataFrame:
    """The histogram with docs and tokens of its length and above, and all below.

    Columns: n_tokens, docs, docs_from, tokens_from, docs_below, tokens_below.
    """
    part = F.floor(F.col("n_tokens") / RANGE)
    rows = hist.withColumn("part", part).withColumn("tokens", F.col("docs") * F.col("n_tokens"))
    up = Window.partitionBy("part").orderBy(F.desc("n_tokens"))
    inner = rows.select("*", F.sum("docs").over(up).alias("d"), F.sum("tokens").over(up).alias("t"))
    # One row for each range of RANGE lengths: few, as lengths are bounded.
    ranges = rows.groupBy("part").agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
    above = Window.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    carried = ranges.select("part", F.coalesce(F.sum("docs").over(above), F.lit(0)).alias("d_up"),
                            F.coalesce(F.sum("tokens").over(above), F.lit(0)).alias("t_up"),
                            F.sum("docs").over(Window.partitionBy(F.lit(1))).alias("all_docs"),
                            F.sum("tokens").over(Window.partitionBy(F.lit(1))).alias("all_tokens"))
    full_d, full_t = F.col("d") + F.col("d_up"), F.col("t") + F.col("t_up")
    return inner.join(carried, "part").select(
        "n_tokens", "docs", full_d.alias("docs_from"), full_t.alias("tokens_from"),
        (F.col("all_docs") - full_d).alias("docs_below"), (F.col("all_tokens") - full_t).alias("tokens_below"))


def at_limits(sums: DataFrame, limits: Sequence[int] = LIMITS) -> DataFrame:
    """For each limit: documents and tokens in all, documents over it, tokens
    kept and lost when every text is cut there."""
    over = [F.col("n_tokens") > lim for lim in limits]
    one = sums.agg(
        F.coalesce(F.sum("docs"), F.lit(0)).alias("docs"),
        F.coalesce(F.sum(F.col("docs") * F.col("n_tokens")), F.lit(0)).alias("tokens"),
        F.array(*[F.struct(
            F.lit(lim).cast("long").alias("context"),
            # The suffix sums at the first length over the limit.
            F.coalesce(F.max(F.when(o, F.col("docs_from"))), F.lit(0)).alias("docs_over"),
            F.coalesce(F.max(F.when(o, F.col("tokens_from"))), F.lit(0)).alias("tokens_of_over"))
            for lim, o in zip(limits, over, strict=True)]).alias("at"))
    rows = one.select("docs", "tokens", F.explode("at").alias("a")).select("docs", "tokens", "a.*")
    lost = F.col("tokens_of_over") - F.col("docs_over") * F.col("context")
    return rows.select("context", "docs", "tokens", "docs_over", lost.alias("tokens_lost"),
                       (F.col("tokens") - lost).alias("tokens_kept"))


def quantiles(sums: DataFrame, wanted: Sequence[float] = QUANTILES) -> DataFrame:
    """(quantile, n_tokens): the smallest length that this share of documents does not exceed."""
    total = F.col("docs_below") + F.col("docs_from")
    one = sums.agg(F.array(*[F.struct(
        F.lit(float(q)).alias("quantile"),
        F.min(F.when(F.col("docs_below") + F.col("docs") >= F.ceil(F.lit(float(q)) * total), F.col("n_tokens")))
        .alias("n_tokens")) for q in wanted]).alias("at"))
    return one.select(F.explode("at").alias("a")).select("a.*")


def report(documents: DataFrame, path: str) -> DataFrame:
    """The answers for every context limit, from one encoding of every text.

    A row for each length L that occurs: documents of that length, from it on
    and below; tokens from it on and below; ``truncated_total``, the tokens
    left when every text is cut at L; ``quantile``, the share of documents not
    longer than L.
    """
    sums = suffix_sums(stored(histogram(encoded_lengths(documents, path)), "length_histogram"))
    reached = F.col("docs_below") + F.col("docs")
    return sums.select("*", (F.col("tokens_below") + F.col("n_tokens") * F.col("docs_from")).alias("truncated_total"),
                       (reached / (F.col("docs_below") + F.col("docs_from"))).alias("quantile"))
