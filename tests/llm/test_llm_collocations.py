"""Collocations against a brute force in plain Python."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from clinilake.llm import collocations as c
from llm_data import docs

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _brute(rows, occurrences=10, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            ws = re.findall("[^ \t]+", piece)
            n[lang or "und"] += len(ws)
            for k in (1, 2, 3):
                f[lang or "und"].update(tuple(ws[i:i + k]) for i in range(len(ws) - k + 1))
    out = []
    for lang, counts in f.items():
        longer = Counter()
        for p, a in counts.items():
            if len(p) == 3 and a >= occurrences:
                for q in (p[:2], p[1:]):
                    longer[q] = max(longer[q], a)
        rated = []
        for p, a in counts.items():
            if len(p) == 1 or a < occurrences or len(p) == 2 and 100 * longer[p] >= 50 * a and longer[p]:
                continue
            cuts = [(1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]])
                    for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            rated.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s)
                for i, (s, a, p, left, right) in enumerate(sorted(rated)[:top])]
    return sorted(out)


def _got(df, **more):
    got = c.collocations(df, **more)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in got.collect())


def _rows(seed=3, n=300):
    rng = random.Random(seed)
    words = ["New", "york", "city", "é", "ÉA", "of", "the", "a\u00a0b", "x-y", "北京", "hot"]
    out = []
    for i in range(n):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n", "\x0b", " \r\n"])
                       for _ in range(rng.randint(0, 60)))
        out.append((rng.choice(["en", "fr", None, "und"]), text + "new york city " * (i % 3)))
    return out + [("en", None), (None, ""), ("en", ".,;:!?\n"), ("en", "hot " * 3000)]


def test_collocations_equal_brute_force(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "lang string, text string")
    want = _brute(rows)
    assert _got(df) == want and {r[0] for r in want} == {"en", "fr", "und"}
    assert _got(df, occurrences=3, top=7) == _brute(rows, 3, 7)


def test_bursts_spills_and_slices_change_nothing(spark, monkeypatch):
    """Tiny limits: containers burst, subtrees spill, words start over, texts are cut."""
    rows = _rows(8, 120)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    for name, value in (("BURST", 3), ("HELD", 40), ("AT_ONCE", 50), ("SLICE", 16), ("WORDS", 15), ("BRANCH", 1)):
        monkeypatch.setattr(c, name, value)
    # The limits live in this process: the tasks' side is called here.
    batches = df.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text")).toArrow()
    counts = Counter()
    for batch in c.Counter()(iter(batches.to_batches())):
        for lang, a, b, n in zip(*[batch.column(x).to_pylist() for x in ("lang", "w1", "w2", "n")]):
            counts[lang, a, b] += n
    want = Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            ws = re.findall("[^ \t]+", piece)
            want.update((lang or "und", w, None) for w in ws)
            want.update((lang or "und", a, b) for a, b in zip(ws, ws[1:]))
    assert counts == want


def test_runs_are_sorted_and_subtrees_whole():
    words, trie = c.Words(), c.PhraseTrie()
    ids = c.word_ids(b"d a c a b a c d d a", words)
    pairs, count = np.unique(ids[:-2] << 32 | ids[1:-1], return_counts=True)
    trie.add(pairs >> 32 + c.BRANCH, pairs, count)
    assert trie.size == len(pairs)
    run, = c.Counter._spilled({("en", 2): trie}, words, 0)
    got = list(zip(run.column("w1").to_pylist(), run.column("w2").to_pylist()))
    assert got == sorted(got) and trie.size == 0


def test_scores_beyond_64_bits_are_exact(spark):
    a, left, right = 3_000_000_000_000_007, 9_000_000_000_000_001, 8_000_000_000_000_003
    df = spark.createDataFrame([(a, left, right), (a, a, a), (10, 1_000_000, 1_000_000)], "a long, l long, r long")
    got = [r[0] for r in df.select(c._score(F.col("a"), F.col("l"), F.col("r"))).collect()]
    assert got == [1000000 * a * a // (left * right), 1000000, 0]


def test_the_bitmap_is_the_same_in_both_places(spark):
    class Held:
        value = None
    pairs = spark.createDataFrame([("en", "new", "york"), ("fr", "é", "北京")], "lang string, w1 string, w2 string")
    counter, words = c.Counter(Held), c.Words()
    Held.value = c._bitmap(pairs)
    ids = c.word_ids("new york é 北京".encode(), words)
    counter.hashes = np.array([c.xxhash.xxh64_intdigest(w, c.SEED) for w in words.names], np.uint64)
    assert counter._frequent("en", ids[[0, 0, 2]], ids[[1, 2, 3]]).tolist() == [True, False, False]
    assert counter._frequent("fr", ids[[2, 3]], ids[[3, 2]]).tolist() == [True, False]


def test_awkward_and_empty_tables(spark):
    table = docs(spark)
    rows = [(r.lang, r.text) for r in table.collect()]
    assert _got(table, occurrences=2) == _brute(rows, 2)
    assert _got(table.limit(0)) == []
