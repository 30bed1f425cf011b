r"""Mixing sources to target weights by Pfair windows and earliest deadlines.

Each source's rows, in a fixed pseudo-random order, are cut into blocks.  With
weight w, a source's j-th block (from 0) may not run before slot floor(j / w)
and must run before slot ceil((j + 1) / w).  One block runs in each slot: of
the released ones that with the earliest deadline, ties to the smaller share
left over and then to the source's name.  Weights add up to one, so every
deadline is met, and after any number t of slots a source has run between
t * w - 1 and t * w + 1 blocks.

Weights are exact whole numbers, as the floats given stand, so these bounds hold
against the targets themselves, however many sources and slots there are.  When
a source runs out, a new phase begins: the rest go on with their weights scaled
up, counted anew.  Slots are dealt in one pass over the blocks, by a task that
holds a few numbers for each source and writes the slots as it goes; rows meet
theirs in a join.

With a ``cycle``, weights are rounded to multiples of 1 / ``cycle`` (largest
remainders, one multiple at least) and the windows repeat after ``cycle``
slots: one cycle is laid out for each phase, and the bounds hold against the
rounded weights only.

No row is dropped or repeated: the mix is an order of all rows.

The numbers of a source's rows come from counts of hash buckets, so a source
with a third of all rows is numbered by many tasks.

Without given weights a source of n rows weighs n ** ``TEMPER``.

Defined results: a null source is a source of its own (``UNKNOWN``); given
weights need not add up to one nor name every source (see :func:`targets`);
weights must be positive; rows that repeat a doc_id each have a place, next to
each other in any order; a null doc_id is a key like any other; an empty table
gives no rows; more sources than the slots of a given cycle are an error.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Callable, Iterator, Mapping
from fractions import Fraction

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from .common import stored, whole_row

BLOCK_ROWS = 16
#: Slots of a cycle that is laid out alone.
CYCLE = 1000
#: Blocks of a source that share a row of the table of slots.
PART_BLOCKS = 256
#: Rows of a hash bucket of a source, about.
BUCKET_ROWS = 4096
TEMPER = 0.5
UNKNOWN = "(none)"


def rounded(weights: Mapping[str, float], cycle: int = CYCLE) -> dict[str, int]:
    """Shares of ``cycle`` that add up to it, one at least, by largest remainder."""
    if len(weights) > cycle:
        raise ValueError(f"more than {cycle} sources need a longer cycle")
    total = sum(map(Fraction, weights.values()))
    exact = {s: Fraction(w) / total * cycle for s, w in weights.items()}
    shares = {s: int(x) for s, x in exact.items()}
    by_rest = sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s))
    for s in by_rest[:cycle - sum(shares.values())]:
        shares[s] += 1
    for s in sorted(s for s, a in shares.items() if not a):
        shares[max(shares, key=lambda x: (shares[x], x))] -= 1
        shares[s] = 1
    return shares


def targets(counts: Mapping[str, int], weights: Mapping[str, float]) -> dict[str, float]:
    """Each source's share of the mix, adding up to one.

    Given weights are shares as they stand while they leave some for the other
    sources, which divide that by their rows; else the others keep their share
    of the rows, and the given ones divide what is left.
    """
    given = {s: w for s, w in weights.items() if s in counts}
    others = {s: n for s, n in counts.items() if s not in given}
    total, rows = sum(given.values()), sum(counts.values())
    rest = 0.0 if not others else 1 - total if total < 1 else sum(others.values()) / rows
    return {s: given[s] / total * (1 - rest) if s in given else others[s] / sum(others.values()) * rest for s in counts}


def one_cycle(shares: Mapping[str, int]) -> list[str]:
    """The source that runs in each slot of a cycle of ``sum(shares)`` slots."""
    cycle = sum(shares.values())
    release: dict[int, list] = {}
    for s, a in shares.items():
        for j in range(a):
            first, last = j * cycle // a, -(-(j + 1) * cycle // a)
            release.setdefault(first, []).append((last, a, s))
    ready: list = []
    slots = []
    for t in range(cycle):
        for block in release.get(t, ()):
            heapq.heappush(ready, block)
        last, _, source = heapq.heappop(ready)
        if last <= t:
            raise AssertionError("a deadline was missed")
        slots.append(source)
    return slots


def phases(blocks: Mapping[str, int], weights: Mapping[str, float], cycle: int = CYCLE) -> list[dict]:
    """The phases between sources' ends: first slot, first block and places by source.

    A phase ends with the slot in which some source's last block runs.
    """
    left = {s: n for s, n in blocks.items() if n}
    done = dict.fromkeys(left, 0)
    at, found = 0, []
    while left:
        shares = rounded({s: weights[s] for s in left}, cycle)
        slots = one_cycle(shares)
        places: dict[str, list[int]] = {s: [] for s in left}
        for t, s in enumerate(slots):
            places[s].append(t)

        def slot_of(s: str, j: int) -> int:
            return j // shares[s] * cycle + places[s][j % shares[s]]

        end = min(slot_of(s, n - 1) for s, n in left.items())
        ran = {s: end // cycle * shares[s] + sum(t <= end % cycle for t in places[s]) for s in left}
        found.append({"start": at, "shares": shares, "first": {s: done[s] for s in left}, "ran": ran, "slots": slots})
        at += end + 1
        for s, n in ran.items():
            done[s] += n
            left[s] -= n
        left = {s: n for s, n in left.items() if n}
    return found


def dealt(blocks: Mapping[str, int], weights: Mapping[str, float]) -> Iterator[tuple[int, str, int]]:
    """(phase, source, its block) of each slot in turn, by exact weights."""
    exact = {s: Fraction(weights[s]) for s, n in blocks.items() if n}
    unit = max((x.denominator for x in exact.values()), default=1)  # floats: powers of two
    whole = {s: int(x * unit) for s, x in exact.items()}
    done = dict.fromkeys(whole, 0)
    phase = 0
    while whole:
        total, t = sum(whole.values()), 0
        # Each source's next block: released ones by deadline, the others by release.
        ready = [(-(-total // a), a, s, 0) for s, a in whole.items()]
        heapq.heapify(ready)
        waiting: list = []
        while True:
            while waiting and waiting[0][0] <= t:
                heapq.heappush(ready, heapq.heappop(waiting)[1])
            last, a, s, j = heapq.heappop(ready)
            if last <= t:
                raise AssertionError("a deadline was missed")
            yield phase, s, done[s]
            done[s] += 1
            t += 1
            if done[s] == blocks[s]:
                del whole[s]
                break
            heapq.heappush(waiting, ((j + 1) * total // a, (-(-(j + 2) * total // a), a, s, j + 1)))
        phase += 1


SLOTS = "_source string, _part long, _slots array<long>, _phases array<int>"


def _slots(blocks: dict[str, int], weights: dict[str, float]):
    """The table of slots: a row for each ``PART_BLOCKS`` blocks of a source."""
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.string(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32())]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)],
                                          names=["_source", "_part", "_slots", "_phases"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            pass
        open_parts: dict[str, tuple[list, list]] = defaultdict(lambda: ([], []))
        full: list[tuple] = []
        for slot, (phase, s, block) in enumerate(dealt(blocks, weights)):
            open_parts[s][0].append(slot)
            open_parts[s][1].append(phase)
            if block % PART_BLOCKS == PART_BLOCKS - 1 or block + 1 == blocks[s]:
                full.append((s, block // PART_BLOCKS, *open_parts.pop(s)))
                if len(full) == 256:
                    yield batch(full)
                    full = []
        yield batch(full)
    return deal


def _numbered(rows: DataFrame, source: Column, key: Column, print_: Column,
              slim: DataFrame | None = None) -> tuple[DataFrame, dict[str, int]]:
    """``rows`` with ``_source`` and ``_n``, their number within the source from 0.

    What is counted ahead is counted over ``slim``: the same rows, without what is
    dear to make.
    """
    def keyed(df: DataFrame) -> DataFrame:
        return df.select("*", source.alias("_source"), key.alias("_key"), print_.alias("_print"))

    slim = rows if slim is None else slim
    counts = {r._source: r.n for r in keyed(slim).groupBy("_source").agg(F.count(F.lit(1)).alias("n")).collect()}
    # Buckets are ranges of the hash, so bucket order is key order; a row for each source.
    buckets = rows.sparkSession.createDataFrame(
        [(s, -(-n // BUCKET_ROWS)) for s, n in counts.items()], "_source string, _buckets long")
    bucket = F.floor(F.shiftrightunsigned("_key", 32) * F.col("_buckets") / F.lit(1 << 32)).cast("long")
    def cut(df: DataFrame) -> DataFrame:
        return keyed(df).join(F.broadcast(buckets), "_source").withColumn("_bucket", bucket).drop("_buckets")

    sizes = cut(slim).groupBy("_source", "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(sizes.select("_source", "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")),
                    "bucket_starts")
    within = Window.partitionBy("_source", "_bucket").orderBy(F.shiftrightunsigned("_key", 1), "_key", "_print")
    numbered = cut(rows).withColumn("_rank", F.row_number().over(within)).join(starts, ["_source", "_bucket"])
    return numbered.withColumn("_n", F.col("_start") + F.col("_rank") - 1).drop(
        "_start", "_rank", "_bucket", "_key", "_print"), counts


def _scheduled(rows: DataFrame, source: Column, key: Column, print_: Column, weights: Mapping[str, float] | None,
               block_rows: int, cycle: int | None, slim: DataFrame | None = None) -> DataFrame:
    numbered, counts = _numbered(rows, source, key, print_, slim)
    spark = rows.sparkSession
    want = targets(counts, weights or {s: n ** TEMPER for s, n in counts.items()})
    blocks = {s: -(-n // block_rows) for s, n in counts.items()}
    if cycle is None:
        slots = stored(spark.range(0, 1, 1, 1).mapInArrow(_slots(blocks, want), SLOTS), "slots")
        at = (F.col("_block") % PART_BLOCKS).cast("int")
        return (
            numbered.withColumn("_block", F.floor(F.col("_n") / block_rows).cast("long"))
            .withColumn("_part", F.floor(F.col("_block") / PART_BLOCKS).cast("long"))
            .join(slots, ["_source", "_part"])
            .withColumn("_slot", F.get("_slots", at)).withColumn("_phase", F.get("_phases", at))
            .withColumn("_position", F.col("_slot") * block_rows + F.col("_n") % block_rows))
    plan = phases(blocks, want, cycle)
    # Both tables have at most (sources x phases) and (cycle x phases) rows.
    spans = spark.createDataFrame(
        [(i, p["start"], s, p["first"][s], p["first"][s] + p["ran"][s], p["shares"][s])
         for i, p in enumerate(plan) for s in p["shares"]],
        "_phase int, _start long, _source string, _first long, _end long, _share long")
    places = spark.createDataFrame(
        [(i, s, k, t) for i, p in enumerate(plan) for s, k, t in _ranked_places(p["slots"])],
        "_phase int, _source string, _k long, _place long")
    block = F.floor(F.col("_n") / block_rows).cast("long")
    own = F.col("_block") - F.col("_first")
    return (
        numbered.withColumn("_block", block)
        .join(F.broadcast(spans), "_source")
        .where((F.col("_block") >= F.col("_first")) & (F.col("_block") < F.col("_end")))
        .withColumn("_k", own % F.col("_share"))
        .join(F.broadcast(places), ["_phase", "_source", "_k"])
        .withColumn("_slot", F.col("_start") + F.floor(own / F.col("_share")).cast("long") * cycle + F.col("_place"))
        .withColumn("_position", F.col("_slot") * block_rows + F.col("_n") % block_rows))


def _ranked_places(slots: list[str]) -> list[tuple[str, int, int]]:
    seen: dict[str, int] = {}
    out = []
    for t, s in enumerate(slots):
        out.append((s, seen.get(s, 0), t))
        seen[s] = seen.get(s, 0) + 1
    return out


def _source() -> Column:
    return F.coalesce(F.col("source").cast("string"), F.lit(UNKNOWN))


def schedule(documents: DataFrame, weights: Mapping[str, float] | None = None,
             block_rows: int = BLOCK_ROWS, cycle: int | None = None) -> DataFrame:
    """One row per row of ``documents``: doc_id, source, number (in the
    source), block, phase, slot and position (the order of the mix).
    """
    rows = documents.select("doc_id", "source", _print(documents).alias("print"))
    return _scheduled(rows, _source(), F.xxhash64("doc_id"), F.col("print"), weights, block_rows, cycle).select(
        "doc_id", F.col("_source").alias("source"), F.col("_n").alias("number"), F.col("_block").alias("block"),
        F.col("_phase").alias("phase"), F.col("_slot").alias("slot"), F.col("_position").alias("position"))


def _print(documents: DataFrame) -> Column:
    """Orders the rows of one doc_id and source, so that a task run again gives them the same places."""
    return F.xxhash64("text") if "text" in documents.columns else F.lit(0).cast("long")


def row_key(documents: DataFrame) -> Column:
    """A number for each row; rows with one number may swap their places of the mix."""
    return F.xxhash64("doc_id", "source", _print(documents))


def with_positions(rows: DataFrame, key: str, documents: DataFrame,
                   weights: Mapping[str, float] | None = None) -> DataFrame:
    """``rows`` and position, the place of each in the mix of ``documents``.

    ``rows`` has one row per row of ``documents``, with its :func:`row_key` in
    the column ``key``.  The schedule is made of a few numbers a row: whatever
    ``rows`` carries moves once, by key.
    """
    slim = documents.select("doc_id", "source", row_key(documents).alias("_row"), _print(documents).alias("_text"))
    places = stored(_scheduled(slim, _source(), F.xxhash64("doc_id"), F.col("_text"), weights, BLOCK_ROWS, None).select(
        "_row", F.col("_position").alias("position")), "places")
    again = stored(places.groupBy("_row").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(
        F.col("_row").alias("_again")), "again")
    here, there = F.col(key) == F.col("_again"), F.col("_row") == F.col("_again")
    if again.isEmpty():
        return rows.join(places, F.col(key) == F.col("_row")).drop("_row")
    # Rows that repeat a key take its places in turn.
    rows = stored(rows, "rows")
    copy = F.row_number()
    left = rows.join(again, here, "left_semi").withColumn("_copy", copy.over(Window.partitionBy(key).orderBy(key)))
    right = places.join(again, there, "left_semi").withColumn("_turn", copy.over(Window.partitionBy("_row").orderBy("position")))
    repeated = left.join(right, (F.col(key) == F.col("_row")) & (F.col("_copy") == F.col("_turn"))).drop(
        "_copy", "_row", "_turn")
    single = rows.join(again, here, "left_anti").join(places.join(again, there, "left_anti"), F.col(key) == F.col("_row"))
    return single.drop("_row").unionByName(repeated)


def _rewriting(at: int, make: Callable[[], Callable], kind: pa.DataType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A step that rewrites one column's values that are not null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        change = make()
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                columns = list(part.columns)
                columns[at] = pa.array([None if x is None else change(x) for x in columns[at].to_pylist()], kind)
                yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)
    return run


def _press() -> Callable[[str], bytes]:
    pack = zstandard.ZstdCompressor().compress
    return lambda text: pack(text.encode())


def _expand() -> Callable[[bytes], str]:
    unpack = zstandard.ZstdDecompressor().decompress
    return lambda data: unpack(data).decode()


def mix(documents: DataFrame, weights: Mapping[str, float] | None = None,
        block_rows: int = BLOCK_ROWS, cycle: int | None = None) -> DataFrame:
    """All rows of ``documents``, with their columns, sorted by the mix's order.

    The order is that of the rows, so of the files written from them.
    """
    names, kinds = documents.columns, [f.dataType for f in documents.schema]
    places = [f"c{i}" for i in range(len(names))]
    given = documents.select(
        *[c.alias(p) for c, p in zip(whole_row(documents), places, strict=True)], _source().alias("_from"),
        F.xxhash64("doc_id").alias("_hash"), _print(documents).alias("_text"))
    rows, at = given, names.index("text") if "text" in names and documents.schema["text"].dataType == StringType() else -1
    if at >= 0:  # texts move twice, to be numbered and to be sorted: compressed
        packed = StructType([StructField(f.name, BinaryType() if i == at else f.dataType) for i, f in enumerate(given.schema)])
        rows = given.mapInArrow(_rewriting(at, _press, pa.binary()), packed)
    placed = _scheduled(rows, F.col("_from"), F.col("_hash"), F.col("_text"), weights, block_rows, cycle, given)
    ordered = placed.select(*places, "_position").orderBy("_position").select(*places)
    if at >= 0:
        ordered = ordered.mapInArrow(_rewriting(at, _expand, pa.string()), StructType(
            [StructField(p, kind) for p, kind in zip(places, kinds, strict=True)]))
    return ordered.toDF(*names)
