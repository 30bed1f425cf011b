"""Order-dependent operators that stay balanced when one key is huge.

``Window.partitionBy(key)`` sends every row of a key to one task, so a key
holding a third of the data makes one task do a third of the work.  Here rows
go to *buckets* that are pure functions of the row and follow the sort order,
and what crosses a bucket boundary is one summary of each bucket: within keys, a
bucket is an hour or the beginning of a text, and the summary a row that joins
the data and sorts before its bucket; over a whole table, buckets are ranges
between sampled splitters, and the summaries a one-row subquery.  The data is
shuffled once, by bucket.

All operators are lazy: nothing runs, is cached or is written before the
caller's own action, and a lost executor only repeats its own tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinilake.names import col, fresh, quoted

#: Rows of one key that one task sorts without trouble.  Keys with more are
#: cut into buckets; there are at most (rows / HOT_ROWS) such keys.
HOT_ROWS = 1_000_000
#: Leading characters of a text that make its bucket.
PREFIX = 8
#: Ranges of a global numbering, and expected sampled rows for each of them.
BUCKETS, SAMPLES = 512, 16
#: Equal rows that travel as one.
COPIES = 1024


def _time_bucket(df: DataFrame, name: str) -> Column:
    """A function of the column that follows its order and cuts it coarsely."""
    kind = dict(df.dtypes)[name]
    if kind == "date":
        return col(name)
    if kind in ("timestamp", "timestamp_ntz"):
        return F.date_trunc("hour", col(name))
    if kind == "string":
        return F.substring(col(name), 1, PREFIX)
    return F.floor(col(name) / 1024)


def lag_within(df: DataFrame, key: str, order: Sequence[str], values: Sequence[str],
               prefix: str = "prev_", partitions: int | None = None, hot_rows: int = HOT_ROWS,
               bucket: Column | None = None) -> DataFrame:
    """Add ``prefix + v`` = value of ``v`` on the previous row of the same
    ``key`` in ``order`` (null on a key's first row).

    Same result as ``lag(v).over(Window.partitionBy(key).orderBy(*order))``
    (null keys form one group); ``order`` should make rows of a key unique
    (add a tie-breaker), otherwise the predecessor among ties is arbitrary, as
    with the window.

    Keys with more than ``hot_rows`` rows are found by one aggregation and
    broadcast (at most rows / ``hot_rows`` of them); their rows go to tasks by
    ``(key, bucket)``.  ``bucket`` must be a function of the first order column
    that follows its order; by default it is a date, the hour of a timestamp,
    the beginning of a text, or a range of 1,024 of a number.
    """
    order, values = list(order), list(values)
    hot_key, hot, at, carried, last, row = fresh(
        ["hot_key", "hot", "bucket", "carried", "last", "row"], df.columns)
    counted = df.groupBy(col(key)).agg(F.count(F.lit(1)).alias(row)).where(F.col(row) > hot_rows).select(
        col(key).alias(hot_key), F.lit(True).alias(hot))
    bucket = _time_bucket(df, order[0]) if bucket is None else bucket
    placed = df.join(F.broadcast(counted), col(key).eqNullSafe(F.col(hot_key)), "left").select(
        *[col(c) for c in df.columns], F.when(F.col(hot), bucket).alias(at), F.col(hot),
        F.lit(False).alias(carried))
    # Each hot bucket's last row, handed on to the key's next bucket.
    carry = list(dict.fromkeys([*order, *values]))
    ends = placed.where(F.col(hot)).groupBy(col(key), F.col(at)).agg(
        F.max_by(F.struct(*[col(c) for c in carry]), F.struct(*[col(c) for c in order])).alias(last))
    handed = ends.select(col(key), F.col(at), F.lag(last).over(Window.partitionBy(col(key)).orderBy(at)).alias(last)
                         ).where(F.col(last).isNotNull())
    extra = handed.select(
        *[col(key) if c == key else F.col(f"{last}.{quoted(c)}").alias(c) if c in carry
          else F.lit(None).cast(df.schema[c].dataType).alias(c) for c in df.columns],
        F.col(at), F.lit(True).alias(hot), F.lit(True).alias(carried))
    rows = placed.unionByName(extra)
    if partitions:
        rows = rows.repartition(partitions, col(key), F.col(at))
    w = Window.partitionBy(col(key), F.col(at)).orderBy(*[col(c) for c in order])
    return (rows.select("*", *[F.lag(col(v)).over(w).alias(prefix + v) for v in values])
            .where(~F.col(carried)).drop(at, hot, carried))


def splitters(df: DataFrame, key: Column, weight: Column, buckets: int = BUCKETS) -> DataFrame:
    """One row with one column, ``cuts``: a sorted array of at most ``buckets - 1``
    keys that cut the rows of ``df`` into ranges of about equal weight.

    ``key`` must tell the rows apart.  A row is drawn by its key's hash, with a
    chance that follows its weight, so that :data:`SAMPLES` rows for each range are
    expected whatever the size of ``df``; they meet in one task.  The sample is a
    pure function of the rows: the same in every evaluation and every retry.
    """
    rows = df.select(key.alias("key"), weight.alias("weight"))
    total = rows.agg(F.sum("weight").cast("double").alias("total")).scalar()
    # Uniform in (0, 1]; -ln(u) is below r * w with the chance 1 - exp(-r * w).
    uniform = (F.shiftrightunsigned(F.xxhash64("key"), 11) + 1) / F.lit(float(1 << 53))
    drawn = rows.where(-F.log(uniform) * total <= F.col("weight") * SAMPLES * buckets)
    places = F.sequence(F.lit(1), F.lit(buckets - 1)) if buckets > 1 else F.array().cast("array<int>")
    return drawn.agg(F.array_sort(F.collect_list("key")).alias("keys")).select(
        F.array_distinct(F.filter(F.transform(
            places, lambda i: F.get(F.col("keys"), F.floor(i * F.size("keys") / buckets).cast("int"))),
            lambda k: k.isNotNull())).alias("cuts"))


def ranged(df: DataFrame, key: Column, cuts: Column, at: str, buckets: int = BUCKETS) -> DataFrame:
    """Adds ``at``: how many of the sorted ``cuts`` are at most ``key``.

    A binary search of one projection for each step, without higher-order
    functions: all steps are one generated loop body, in which the array of the
    cuts (a subquery) is one variable, and no row carries it.
    """
    whole, own = fresh(["cuts", "key"], [*df.columns, at])
    out = df.select("*", cuts.alias(whole), key.alias(own), F.lit(0).alias(at))
    for step in reversed([1 << k for k in range(max(1, (buckets - 1).bit_length()))]):
        reached = F.get(F.col(whole), F.col(at) + (step - 1)) <= F.col(own)  # null beyond the last one
        out = out.withColumn(at, F.col(at) + F.when(reached, F.lit(step)).otherwise(F.lit(0)))
    return out.drop(whole, own)


def row_index(df: DataFrame, order: Sequence[str], id_col: str = "id", partitions: int | None = None,
              copies: bool = True, buckets: int = BUCKETS) -> DataFrame:
    """Every row of ``df`` numbered 1..n in ``order``.

    Equal to ``row_number() over (order by order)`` (rows tied on ``order``
    are numbered by a hash of the row), without a sort in a single task: rows go
    to ranges between :func:`splitters`, so each task sorts an equal share
    whatever the values look like, and a row's number is its place in its range
    after the rows of all earlier ranges.  Splitters and the ranges' sizes are
    one-row subqueries (at most ``buckets`` entries), so nothing is joined or
    broadcast by key, and nothing runs before the caller's own action.  The
    input is planned four times (total, sample, sizes, rows); Spark runs a shuffle
    that these have in common once.

    Rows that repeat as a whole are counted first (map-side) and travel as one
    row for each :data:`COPIES` of them; ``copies=False`` says that there are
    none and saves that shuffle.
    """
    order = list(order)
    n, part, row, at, place, again = fresh(["n", "part", "row", "at", "place", "again"], [*df.columns, id_col])
    rows = df.select(*[col(c) for c in df.columns], F.lit(1).cast("long").alias(n), F.lit(0).cast("long").alias(part))
    if copies:
        counted = df.groupBy(*[col(c) for c in df.columns]).agg(F.count(F.lit(1)).alias(n))
        rows = counted.select("*", F.explode(F.sequence(
            F.lit(0).cast("long"), F.floor((F.col(n) - 1) / COPIES).cast("long"))).alias(part)).withColumn(
            n, F.least(F.lit(COPIES), F.col(n) - F.col(part) * COPIES))
    told = [*[col(c) for c in order], F.xxhash64(*[col(c) for c in df.columns]), F.col(part)]
    key = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(told)])
    cut = splitters(rows, key, F.col(n), buckets).scalar()
    placed = ranged(rows, key, cut, at, buckets)
    sizes = placed.groupBy(at).agg(F.sum(n).alias(n))  # a row for each range
    below = F.aggregate(F.filter(F.col(row), lambda s: s["at"] < F.col(at)), F.lit(0).cast("long"),
                        lambda total, s: total + s["n"])
    starts = (sizes.agg(F.collect_list(F.struct(F.col(at).alias("at"), F.col(n).alias("n"))).alias(row))
              .select(F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias(at), row)
              .agg(F.sort_array(F.collect_list(F.struct(F.col(at), below.alias("start"))))["start"])).scalar()
    if partitions:
        placed = placed.repartition(partitions, at)
    w = Window.partitionBy(at).orderBy(*told).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = placed.withColumn(place, F.get(starts, F.col(at)) + F.sum(n).over(w))
    if not copies:
        return numbered.select(*[col(c) for c in df.columns], F.col(place).alias(id_col))
    return (numbered.withColumn(again, F.explode(F.sequence(F.col(place) - F.col(n) + 1, F.col(place))))
            .select(*[col(c) for c in df.columns], F.col(again).alias(id_col)))


def dense_index(df: DataFrame, cols: Sequence[str], id_col: str = "id",
                partitions: int | None = None) -> DataFrame:
    """Distinct values of ``cols`` numbered 1..n in sort order.

    Equal to ``row_number() over (order by cols)`` on the distinct values,
    computed without moving all values into one task (see :func:`row_index`).
    """
    cols = list(cols)
    return row_index(df.select(*[col(c) for c in cols]).distinct(), cols, id_col, partitions, copies=False)
