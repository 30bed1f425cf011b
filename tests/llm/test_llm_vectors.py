import random

import pytest
from pyspark.sql import functions as F

from clinilake.llm import vectors


def _brute(rows, asks, k):
    import math
    good = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    queries = {}
    for i, v in good:
        if asks(i):
            queries[i] = min(queries.get(i, v), v)
    out, limit = [], (1 << 63) - 1
    for q, x in queries.items():
        scored = sorted((-max(-limit - 1, min(limit, sum(a * b for a, b in zip(x, v)))), i) for i, v in good if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def _rows(n=700, dim=6):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(dim)]) for i in range(n)]
    rows += [(n + i, rows[5][1]) for i in range(60)]  # ties
    rows += [(2000, None), (2010, [0.1, None, 0.2]), (2020, [float("nan")] * dim), (2030, [float("inf")] * dim),
             (None, rows[0][1]), (2040, []), (2050, [1.0]), (10, rows[7][1])]
    return rows


@pytest.mark.parametrize("shard", [64, 5000])
def test_top_k_matches_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(vectors, "SHARD_ROWS", shard)
    monkeypatch.setattr(vectors, "BLOCK_QUERIES", 30)
    rows = _rows()
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("shard", F.lit("x"))
    got = sorted(map(tuple, vectors.top_k(table, F.col("vec_id") % 10 == 0, 10).collect()))
    assert got == _brute(rows, lambda i: i % 10 == 0, 10)


def test_few_rows_huge_components_and_empty(spark):
    rows = [(0, [1e30, -2.0]), (1, [1e12, 3.0]), (2, [-1e12, 5.0]), (100, [2.0 ** 40, 0.5])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, vectors.top_k(table, F.col("vec_id") % 100 == 0, 10).collect()))
    limit = (1 << 63) - 1
    # Components end at a long's limits too.
    whole = [(i, [max(-limit - 1, min(limit, int(1024 * x))) for x in v]) for i, v in rows]
    expected = []
    for q, x in whole:
        if q % 100 == 0:
            scored = sorted((-max(-limit - 1, min(limit, sum(a * b for a, b in zip(x, v)))), i) for i, v in whole if i != q)
            expected += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    assert got == sorted(expected)
    assert vectors.top_k(table.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_boxes_bound_every_score():
    import numpy as np
    rng = np.random.default_rng(1)
    points = rng.integers(-900, 900, (500, 5)).astype(float)
    tree, queries = vectors.Tree(points), rng.integers(-900, 900, (20, 5)).astype(float)
    bounds = tree.bounds(queries)
    for node, (a, b, left, right) in enumerate(tree.nodes):
        assert (bounds[:, node] >= (queries @ tree.points[a:b].T).max(axis=1) - 1e-9).all()
    leaves = sum(b - a for a, b, left, _ in tree.nodes if not left)
    assert leaves == 500 and sorted(tree.order) == list(range(500))
