"""Near-duplicate groups: MinHash bands, odd sketches, exact confirmation.

1. One scan makes each document's signature: the size of its shingle set, a
   128-bit fingerprint of the set, keys of bands of MinHash values (:func:`banding`),
   and an odd sketch, the parity bitmap into which all MinHash samples are
   folded.  Documents with one fingerprint form a class; from here on only its
   smallest document counts.
2. Classes that share a band key meet in a bucket.  No bucket emits its pairs:
   its members are compared to one *pivot*, a pair for each member.
3. The XOR of two odd sketches is the sketch of the samples in which they
   differ; its population count bounds the similarity from above.  Pairs over
   :func:`most_bits` go (a pair at the threshold exceeds that once in 10**8),
   the rest is confirmed on the full sets.
4. Buckets whose members still lie in several components compare them to a few
   other pivots.  At last every member meets the members of the *other*
   components: rows without a partner within the bounds go (a semi join), and
   the rest is joined with full sets, confirmed inside the join and only in the
   first bucket that a pair shares, so that links alone come out.  So each
   linked pair of one bucket ends in one component; a pair at the threshold,
   whatever that is, shares no bucket once in 10**7 at most.
5. Components of the confirmed links by alternating stars; links found later
   tie components, so that later rounds work on these links alone.

Defined results: null or empty texts and texts without words have an empty set
and link with nothing; rows that repeat a doc_id are joined as one node and
each gets a row; a null doc_id has no component and is kept; an empty table
gives no rows; extra columns are ignored by :func:`groups` and kept by
:func:`drop_copies`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shingles
from .common import stored, whole_row

#: MinHash values of a band, where the samples are enough for that.
ROWS = 4
SAMPLES = 512
SKETCH_BITS = 1024
#: Rounds with other pivots, and pivots of a bucket in each.
PIVOT_ROUNDS, PIVOTS = 1, 4
#: Rows of a bucket that one task compares to the others.
CHUNK_ROWS = 64

_SEEDS = np.random.default_rng(7).integers(1, 1 << 32, (2, SAMPLES), dtype=np.uint32)
_TIMES, _PLUS = _SEEDS[0] | np.uint32(1), _SEEDS[1]
_SLOT = np.random.default_rng(8).integers(1, 1 << 63, SAMPLES, dtype=np.uint64)

SIGNATURE = ("doc_id long, n_shingles long, fp_a long, fp_b long, bands array<long>, sketch array<long>")


@lru_cache(maxsize=8)
def banding(percent: int, miss: float = 1e-7) -> tuple[int, int]:
    """(bands, values of each): two sets of that similarity share no band with
    probability ``miss`` at most.  Fewer values where bands of ``ROWS`` would
    need more than the samples."""
    for rows in range(ROWS, 0, -1):
        share = (percent / 100) ** rows
        bands = 1 if share >= 1 else math.ceil(math.log(miss) / math.log1p(-share)) if share else SAMPLES + 1
        if bands * rows <= SAMPLES:
            return bands, rows
    raise ValueError(f"a threshold of {percent} % needs more than {SAMPLES} samples")


@lru_cache(maxsize=8)
def most_bits(percent: int, miss: float = 1e-8) -> int:
    """The population count that two sketches of that similarity exceed with
    probability ``miss`` at most: samples differ binomially, and each
    differing sample flips two random bits."""
    flips = np.zeros(SKETCH_BITS + 1)
    flips[0] = 1.0
    share = (100 - percent) / 100
    differ = (1 - share) ** SAMPLES
    total = np.zeros(SKETCH_BITS + 1)
    w = np.arange(SKETCH_BITS + 1)
    for d in range(SAMPLES + 1):
        total += differ * flips
        differ *= (SAMPLES - d) / (d + 1) * share / (1 - share)
        for _ in range(2):
            step = np.zeros_like(flips)
            step[1:] += flips[:-1] * (SKETCH_BITS - w[:-1]) / SKETCH_BITS
            step[:-1] += flips[1:] * w[1:] / SKETCH_BITS
            flips = step
    tail = np.cumsum(total[::-1])[::-1]
    return int(np.flatnonzero(tail > miss)[-1])


def _sketches(samples: np.ndarray) -> np.ndarray:
    """Odd sketches of rows of MinHash samples: parities as 64-bit words."""
    slots = (shingles.mixed(samples + _SLOT) >> np.uint64(40)) % np.uint64(SKETCH_BITS)
    flat = np.arange(len(samples))[:, None] * SKETCH_BITS + slots.astype(np.int64)
    parity = np.bincount(flat.ravel(), minlength=len(samples) * SKETCH_BITS) & 1
    return np.packbits(parity.astype(np.uint8).reshape(len(samples), SKETCH_BITS), axis=1).view(np.int64)


def _samples(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """MinHash samples of each row (none of them empty): rows x SAMPLES, of 32 bits each."""
    out = np.empty((SAMPLES, len(rows) - 1), np.uint32)
    high = (hashes >> np.uint64(32)).astype(np.uint32)
    for k in range(SAMPLES):
        np.minimum.reduceat(high * _TIMES[k] + _PLUS[k], rows[:-1], out=out[k])
    return out.T.astype(np.uint64)


def _sets(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, shingle hashes, row starts) of blocks of rows."""
    for first, data, rows in shingles.text_blocks(batch.column("text")):
        yield first, *shingles.shingle_hashes(*shingles.word_hashes(data, rows), width)


def _long_lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()),
                                    pa.array(values.ravel(), pa.int64()))


def _signatures(width: int, percent: int):
    n_bands, n_rows = banding(percent)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, hashes, rows in _sets(batch, width):
                n = len(rows) - 1
                some = np.flatnonzero(np.diff(rows))
                sizes = np.zeros(n, np.int64)
                prints = np.zeros((n, 2), np.int64)
                for r in some:
                    own = np.unique(hashes[rows[r]:rows[r + 1]])
                    sizes[r] = len(own)
                    prints[r] = np.frombuffer(xxhash.xxh3_128_digest(own.tobytes()), np.int64)
                bands = np.zeros((0, n_bands), np.int64)
                marks = np.zeros((0, SKETCH_BITS // 64), np.int64)
                if len(some):
                    samples = _samples(hashes, np.append(rows[some], len(hashes)))
                    keys = np.broadcast_to(np.arange(n_bands, dtype=np.uint64), (len(some), n_bands)).copy()
                    for k in range(n_rows):
                        keys = shingles.mixed(keys * np.uint64(0xD6E8FEB86659FD93) + samples[:, k:n_bands * n_rows:n_rows])
                    bands, marks = keys.view(np.int64), _sketches(samples)
                full = (sizes > 0).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, n).cast(pa.int64()), pa.array(sizes),
                     pa.array(prints[:, 0].copy()), pa.array(prints[:, 1].copy()),
                     _long_lists(bands, full * n_bands), _long_lists(marks, full * (SKETCH_BITS // 64))],
                    names=["doc_id", "n_shingles", "fp_a", "fp_b", "bands", "sketch"])
    return sign


def _full_sets(width: int):
    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, hashes, rows in _sets(batch, width):
                own = [np.unique(hashes[a:b]) for a, b in zip(rows[:-1], rows[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, len(own)).cast(pa.int64()),
                     _long_lists(np.concatenate(own).view(np.int64), np.array([len(x) for x in own]))],
                    names=["doc_id", "shingles"])
    return full


def _marks() -> Column:
    """Set size and sketch as a struct of numbers that are never null.

    Conditions on pairs then need no tests for nulls or bounds: with these their
    code outgrows what the JVM compiles.
    """
    return F.struct(F.coalesce("n", F.lit(0)).alias("n"), *[
        F.coalesce(F.get("sketch", F.lit(i)), F.lit(0)).alias(f"w{i}") for i in range(SKETCH_BITS // 64)])


def _bits_apart(a: str, b: str) -> Column:
    return reduce(lambda x, y: x + y, [
        F.bit_count(F.col(f"{a}.w{i}").bitwiseXOR(F.col(f"{b}.w{i}"))) for i in range(SKETCH_BITS // 64)])


def _may_link(a: str, b: str, percent: int) -> Column:
    """The size bound, and the sketch bound: both hold for (almost) every linked pair."""
    small, large = F.least(f"{a}.n", f"{b}.n"), F.greatest(f"{a}.n", f"{b}.n")
    return (100 * small >= percent * large) & (_bits_apart(a, b) <= most_bits(percent))


def _sets_of(ids: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """(doc_id, shingles) of the given ids, made anew from their texts."""
    return stored(texts.join(ids, "doc_id", "left_semi").mapInArrow(
        _full_sets(width), "doc_id long, shingles array<long>"), "sets")


def _linked(a: str, b: str, percent: int) -> Column:
    """Whether two full sets reach the similarity."""
    # Named once: a join's condition computes each mention of the intersection anew.
    both = F.size(F.array_intersect(a, b)).cast("long")
    return (100 + percent) * both >= percent * (F.size(a).cast("long") + F.size(b))


def _confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity.

    Only documents in some pair have their sets made again, once; pairs then
    meet both sets by shuffle joins, in which a pivot of many pairs can be split.
    """
    ids = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
    sets = _sets_of(stored(ids, "ids"), texts, width)
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    return pairs.join(left, "a").join(right, "b").where(_linked("sa", "sb", percent)).select("a", "b").distinct()


def _across(open_rows: DataFrame, classes: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """All links (a, b) between members of one bucket and different components.

    ``major`` is one component of the bucket, most likely its largest: only the
    rows outside it look for partners, in it and among each other.
    """
    marks = classes.select("doc_id", _marks().alias("s"), "bands")
    # The band keys before this bucket's, made once for a row and not for each
    # pair; none if the row's doc_id has another text that is not in the bucket.
    earlier = F.slice("bands", F.lit(1), F.greatest(F.array_position("bands", F.col("key")).cast("int") - 1, F.lit(0)))

    def side(rows: DataFrame, x: str) -> DataFrame:
        more = [c for c in ("major", "shingles") if c in rows.columns]
        return rows.join(marks, "doc_id").select(
            "key", F.col("doc_id").alias(x), F.col("component").alias(f"c{x}"), F.col("s").alias(f"s{x}"),
            earlier.alias(f"earlier_{x}"), *[F.col(c).alias(f"{c}_{x}") for c in more]).alias(x)

    near = ((F.col("a.key") == F.col("b.key")) & ((F.col("cb") == F.col("major_a")) | (F.col("ca") < F.col("cb")))
            & _may_link("sa", "sb", percent) & ~F.arrays_overlap("earlier_a", "earlier_b"))
    minor = open_rows.where("component <> major")
    asking = stored(side(minor, "a").join(side(open_rows, "b"), near, "left_semi").select(
        "key", F.col("a").alias("doc_id"), F.col("ca").alias("component"), F.col("major_a").alias("major")), "asking")
    asked = stored(side(open_rows, "b").join(side(asking, "a"), near, "left_semi").select(
        "key", F.col("b").alias("doc_id"), F.col("cb").alias("component")), "asked")
    ids = asking.select("doc_id").unionByName(asked.select("doc_id")).distinct()
    sets = _sets_of(stored(ids, "ids"), texts, width)
    # A bucket's asking rows are dealt to chunks, each of which meets all that
    # are asked: a task has one chunk of a bucket.
    chunks = stored(asking.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / CHUNK_ROWS).alias("chunks")), "chunks")
    a = side(asking.join(sets, "doc_id"), "a").join(chunks, "key").withColumn(
        "chunk", F.pmod(F.xxhash64("a"), F.col("chunks"))).drop("chunks").repartition("key", "chunk").alias("a")
    b = side(asked.join(sets, "doc_id"), "b").join(chunks, "key").withColumn(
        "chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))).drop("chunks").repartition(
        "key", "chunk").alias("b")
    return (a.join(b, (F.col("a.chunk") == F.col("b.chunk")) & near & _linked("shingles_a", "shingles_b", percent))
            .select(F.col("a.a").alias("a"), F.col("b.b").alias("b")).distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node that is not its component's smallest.

    Alternating stars: each node's larger neighbours move to the smallest of
    its neighbourhood, then its smaller ones do, until only stars are left.
    Each round is a few shuffles of the edges; the driver learns only whether
    it was the last.
    """
    def is_done(e: DataFrame) -> bool:
        """Whether each edge is a star's: one way out of a node, none into it."""
        ways = e.select("u", F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
            e.select(F.col("v").alias("u"), F.lit(0).alias("out"), F.lit(1).alias("into")))
        return ways.groupBy("u").agg(F.sum("out").alias("out"), F.max("into").alias("into")).where(
            "out > 1 or out = 1 and into = 1").isEmpty()

    def with_least(e: DataFrame, name: str) -> DataFrame:
        least = stored(e.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), name)
        return e.join(least, "u")

    now = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                 .where("u <> v").distinct(), "edges")
    while not is_done(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stored(with_least(both, "large").where("v > u")
                       .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large_star")
        small = with_least(large, "small")
        now = stored(small.select(F.col("u"), F.col("m").alias("v"))
                     .unionByName(small.select(F.col("v").alias("u"), F.col("m").alias("v")))
                     .where("u <> v").distinct(), "small_star")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))


def joined_components(found: DataFrame, links: DataFrame) -> DataFrame:
    """``found`` (as :func:`components` gives it) after more links.

    Links become edges between components, few beside the links behind
    ``found``; whole components then move to the smallest they reach.
    """
    def of(x: str) -> DataFrame:
        return found.select(F.col("node").alias(x), F.col("component").alias(f"c{x}"))

    ties = links.select("a", "b").join(of("a"), "a", "left").join(of("b"), "b", "left").select(
        F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    moved = components(ties)
    # A component's smallest node is no node of ``found``: it comes with ``moved``.
    return stored(found.join(moved.select(F.col("node").alias("component"), F.col("component").alias("to")), "component", "left")
                  .select("node", F.coalesce("to", "component").alias("component")).unionByName(moved), "joined")


def groups(documents: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``documents``: doc_id, n_shingles, component_id, kept, n_links.

    Documents link when 100 * shared shingles >= percent * united ones, over
    sets of ``width``-word shingles.  ``n_links`` counts the confirmed links of
    the row's class to others; links inside a component may stay untested.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = stored(docs.mapInArrow(_signatures(width, percent), SIGNATURE), "signatures")
    # The smallest document stands for its class; partial aggregation takes the copies.
    classes = stored(
        signed.where("n_shingles > 0 and doc_id is not null").groupBy("fp_a", "fp_b", "n_shingles")
        .agg(F.min(F.struct("doc_id", "bands", "sketch")).alias("c"))
        .select("fp_a", "fp_b", F.col("n_shingles").alias("n"), "c.*"), "classes")
    marks = classes.select("doc_id", _marks().alias("s"))

    rows = classes.select(F.explode("bands").alias("key"), "doc_id")
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("pivot")).where("n > 1")
    members = stored(rows.join(stored(shared.select("key", "pivot"), "buckets"), "key"), "members")
    # Later steps read the texts of bucket members only.
    texts = stored(docs.join(stored(members.select("doc_id").distinct(), "member_ids"), "doc_id", "left_semi"), "texts")
    member_of = classes.select("fp_a", "fp_b", F.col("n").alias("n_shingles"), F.col("doc_id").alias("rep"))
    placed = stored(signed.select("doc_id", "n_shingles", "fp_a", "fp_b")
                    .join(member_of, ["fp_a", "fp_b", "n_shingles"], "left")
                    .select("doc_id", "n_shingles", "rep"), "placed")
    # Rows of one id with different texts are one node: tie their classes.
    same_id = placed.where("rep is not null").groupBy("doc_id").agg(
        F.min("rep").alias("b"), F.max("rep").alias("high")).where("b <> high").select("doc_id", "b")
    ties = placed.join(same_id, "doc_id").where("rep <> b").select(F.col("rep").alias("a"), "b")

    def near(pairs: DataFrame) -> DataFrame:
        """The (a, b) rows within the size and sketch bounds."""
        a = marks.select(F.col("doc_id").alias("a"), F.col("s").alias("sa"))
        b = marks.select(F.col("doc_id").alias("b"), F.col("s").alias("sb"))
        return pairs.join(a, "a").join(b, "b").where(_may_link("sa", "sb", percent)).select("a", "b")

    def confirmed(pairs: DataFrame, name: str) -> DataFrame:
        found = stored(pairs.distinct(), f"{name}_near")
        return stored(_confirmed(found, texts, width, percent), name)

    links = confirmed(near(members.where("doc_id <> pivot").select(
        F.col("doc_id").alias("a"), F.col("pivot").alias("b")).distinct()), "links")
    found = components(links.unionByName(ties))
    for turn in range(1, PIVOT_ROUNDS + 2):
        located = members.select("key", "doc_id").join(found, F.col("doc_id") == F.col("node"), "left").select(
            "key", "doc_id", F.coalesce("component", "doc_id").alias("component"))
        pivots = [F.min(F.struct(F.xxhash64("doc_id", F.lit(turn * PIVOTS + k)), "doc_id", "component")).alias(f"p{k}")
                  for k in range(PIVOTS)]
        mixed = located.groupBy("key").agg(
            F.min("component").alias("low"), F.max("component").alias("high"), *pivots).where("low <> high")
        open_rows = stored(located.join(stored(mixed.select("key", F.array(
            *[F.struct(f"p{k}.doc_id", f"p{k}.component") for k in range(PIVOTS)]).alias("pivots")), "mixed"), "key"),
            "open")
        if turn <= PIVOT_ROUNDS:
            more = confirmed(near(
                open_rows.select("doc_id", "component", F.explode(F.array_distinct("pivots")).alias("p"))
                .where("component <> p.component")
                .select(F.col("doc_id").alias("a"), F.col("p.doc_id").alias("b")).distinct()), f"links_{turn}")
        else:
            rows = open_rows.select("key", "doc_id", "component",
                                    F.get("pivots", F.lit(0))["component"].alias("major"))
            more = stored(_across(rows, classes, texts, width, percent), "links_across")
        links = links.unionByName(more)
        found = joined_components(found, more)

    degree = (links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep")
              .agg(F.count(F.lit(1)).alias("n_links")))
    nodes = found.select(F.col("node").alias("rep"), "component").join(degree, "rep", "full")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id"))
    return placed.join(stored(nodes, "nodes"), "rep", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def drop_copies(documents: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``documents`` with one document of each group: the smallest doc_id.

    All columns stay.  Rows without a doc_id stay; of rows that repeat both
    doc_id and text one stays; rows of one doc_id with different texts are joined
    as one document and stay or go together.
    """
    found = groups(documents, width, percent)
    gone = stored(found.where("not kept").select("doc_id").distinct(), "gone")
    left = documents.join(gone, "doc_id", "left_anti").select(*whole_row(documents))
    again = stored(found.where("kept and doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"),
                   "again")
    if again.isEmpty():
        return left
    one = left.join(again, "doc_id", "left_semi").select(*whole_row(documents)).groupBy("doc_id", "text").agg(
        F.min(F.struct(*whole_row(documents))).alias("row")).select("row.*")
    return one.unionByName(left.join(again, "doc_id", "left_anti").select(*whole_row(documents)))
