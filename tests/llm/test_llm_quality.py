import math
import re

import pytest
from pyspark.sql import functions as F

from clinilake.llm import quality
from llm_data import docs, prose

WORD = re.compile("[^\x20\x09-\x0d]+")


def _brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {p for at in windows.values() if len(at) > 1 for i in at for p in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), symbols, dup, len(covered), failed


def test_base_counts_match_brute_force(spark):
    table = docs(spark)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = quality.assess(table, labels)
    got = sorted(((r.doc_id or -1, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                   r.base_failed) for r in out.collect()))
    assert got == sorted((r.doc_id or -1, *_brute(r.text)) for r in table.collect())
    assert all(r.kept != r.base_failed and r.cutoff is None for r in out.collect())


def test_binomial_tail_is_exact(spark):
    cases = [(k, n) for n in (1, 7, 60, 500, 4000) for k in {0, 1, n // 100, n // 60}]
    df = spark.createDataFrame(cases, "k long, n long").withColumn("p", quality.binomial_tail(F.col("k"), F.col("n"), 0.02))
    for r in df.collect():
        exact = sum(math.comb(r.n, i) * 0.02 ** i * 0.98 ** (r.n - i) for i in range(r.k + 1)) if r.n < 600 else None
        if r.k >= r.n * 0.02:
            assert r.p == 1.0
        elif exact is not None:
            assert r.p == pytest.approx(exact, rel=1e-9)
        else:
            assert 0 < r.p < 1
    huge = spark.createDataFrame([(90_000, 5_000_000)], "k long, n long").select(
        quality.binomial_tail(F.col("k"), F.col("n"), 0.02).alias("p")).first().p
    assert 0 <= huge < 1e-100 or huge == 0.0


def _scored(spark, rows):
    return spark.createDataFrame(rows, "stratum string, risk double, good boolean")


def test_cutoffs_are_safe_per_stratum(spark):
    rows = ([("a", 0.1, True)] * 600 + [("a", 5.0, True)] * 2 + [("a", 9.0, False)] * 50 + [("a", 1.2, False)] * 30
            + [("b", 0.1, True)] * 50 + [("b", 9.0, False)] * 50  # too few labels to be sure
            + [(None, 0.1, True)] * 700 + [(None, 7.0, False)] * 5)
    got = {r.stratum: r for r in quality.choose_cutoffs(_scored(spark, rows)).collect()}
    assert set(got) == {"a", None}
    assert got["a"].cutoff == 1.0 and got["a"].caught == 80 and got["a"].false_rejects == 2
    assert got[None].cutoff == 6.0  # the mildest that catches all


def test_no_more_good_documents_lost_than_promised(spark):
    """On fresh labels the share of good documents lost stays below alpha."""
    import random
    rng = random.Random(1)
    rows = [("a", rng.expovariate(3.0) * (3 if bad else 1), not bad) for bad in (rng.random() < 0.2 for _ in range(6000))]
    chosen = quality.choose_cutoffs(_scored(spark, rows[:3000]), alpha=0.05).first()
    fresh = [r for r in rows[3000:] if r[2]]
    assert sum(r[1] > chosen.cutoff for r in fresh) / len(fresh) <= 0.05


def test_keep_good_keeps_columns_and_clean_rows(spark):
    import random
    rng = random.Random(6)
    rows = [(i, prose(rng, 60), "en", "s") for i in range(900)] + [(1000 + i, "#$% " * 90 + prose(rng, 90), "en", "s")
                                                                  for i in range(60)] + [(2000, None, None, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("risk", F.lit("x"))
    labels = spark.createDataFrame([(r[0], int(r[0] < 1000), 0) for r in rows] + [(None, 1, 0), (5, None, 0), (77777, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    out = quality.keep_good(table, labels)
    assert out.columns == table.columns
    assert sorted(r.doc_id for r in out.collect()) == list(range(900))


def test_empty_tables(spark):
    table = docs(spark).limit(0)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.assess(table, labels).count() == 0
    assert quality.keep_good(table, labels).columns == table.columns
