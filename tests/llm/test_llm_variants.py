"""Spelling variants against a brute force over all pairs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from clinilake.llm import variants
from llm_data import docs

LETTERS = "A-Za-z\u00C0-\u00FF"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def _brute(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall(f"[{LETTERS}]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near = {w: [v for v in words if _near(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return sorted((w, form[w] or "", root(w), words[w], len(near[w]), words[form[w]] if form[w] else 0) for w in words)


def _got(df):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in variants.group(df).collect())


def _table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def _typos(rng, word):
    """The word after one edit of a random place."""
    i, c = rng.randrange(len(word) + 1), rng.choice("abé")
    return rng.choice([word[:i] + c + word[i:], word[:max(0, i - 1)] + word[i:], word[:max(0, i - 1)] + c + word[i:]])


def test_group_equals_brute_force(spark):
    rng = random.Random(11)
    base = ["".join(rng.choice("abcé") for _ in range(rng.randint(4, 9))) for _ in range(40)]
    rows = []
    for i in range(120):
        words = [rng.choice(base) for _ in range(40)]
        words = [_typos(rng, w) if rng.random() < 0.2 else w for w in words]
        words = [_typos(rng, w).upper() if rng.random() < 0.05 else w for w in words]
        rows.append((i if i % 9 else None, rng.choice([" ", "-", "1", "\u0100"]).join(words)))
    # A way of two steps: each word is one edit from the next, twice as frequent.
    rows.append((500, "chainxy " * 3 + "chainxx " * 8 + "chaixxx " * 30))
    got = _got(_table(spark, rows))
    assert got == _brute(rows)
    assert len(got) > 90 and any(r[2] not in (r[0], r[1]) for r in got)


def test_large_tiles_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(variants, "BLOCK", 16)
    words = [f"prefix{a}{b}" for a in "abcdefgh" for b in "abcdefghij"]
    rows = [(i, " ".join(words)) for i in range(3)] + [(3, "prefixab " * 20)]
    assert _got(_table(spark, rows)) == _brute(rows)


def test_nulls_empty_and_awkward_rows(spark):
    table = docs(spark)
    rows = [(r.doc_id, r.text) for r in table.collect()]
    assert _got(table) == _brute(rows)
    assert _got(table.limit(0)) == []
    assert _got(_table(spark, [(1, None), (None, ""), (2, "   "), (3, "abcd " * 9)])) == []


def test_very_long_words_and_texts(spark, monkeypatch):
    monkeypatch.setattr(variants, "SLICE", 100)
    long = "x" * 20_000
    rows = [(1, " ".join([long, long[1:] + "y", long[1:], "short", "short"] * 3)), (2, "words between cuts " * 200)]
    assert _got(_table(spark, rows)) == _brute(rows)


@pytest.mark.parametrize("m", [5, 6, 9])
def test_every_near_pair_counts_in_one_span(m):
    rng = random.Random(m)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.choice([m, m - 1]))).encode() for _ in range(80)})
    a, b = np.triu_indices(len(words), 1)
    found = sum(variants.near_pairs(words, a, b, m, s).astype(int) for s in range(variants.SEGMENTS))
    want = [_near(words[i].decode(), words[j].decode()) and max(len(words[i]), len(words[j])) == m for i, j in zip(a, b)]
    assert found.tolist() == [int(w) for w in want]


def test_no_pairs_leave_a_task(spark):
    from conftest import plan_text
    words = spark.createDataFrame([("abcde", 3), ("abcdf", 9)], "word string, n long")
    text = plan_text(variants.neighbours(words))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert [tuple(r) for r in variants.neighbours(words).orderBy("word").collect()] == [
        ("abcde", 1, 9, "abcdf"), ("abcdf", 1, 3, "abcde")]
