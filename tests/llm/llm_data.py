"""Small tables with the awkward cases, and sessions' helpers for these tests."""

import random

WORDS = "the of stone river walk under light forty grass window paper seven north quick amber".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 99)) for _ in range(n))


def docs(spark, extra=True):
    """Documents with null, empty, blank and long texts, copies, near copies,
    repeated rows and (with ``extra``) columns that clash with inner names."""
    rng = random.Random(4)
    base = prose(rng, 300)
    words = base.split()
    near = " ".join([*words[:150], "changed", *words[151:]])
    far = " ".join([*words[:200], *prose(rng, 100).split()])
    long = " ".join(prose(rng, 2000) for _ in range(4))
    rows = [(1, base), (2, base), (3, near), (4, far), (5, None), (6, ""), (7, " \n\t "), (8, "one"), (9, "One"),
            (10, "two words"), (11, long), (12, long + " end"), (12, long + " end"), (13, prose(rng, 40)),
            (None, base), (14, "x" * 5000), (15, "é " * 300), (16, "a\nb\na\nb\n\n" * 30)]
    table = spark.createDataFrame(
        [(i, t, "en" if k % 3 else None, "s" + str(k % 2) if k % 5 else None, len(t or ""))
         for k, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    if extra:
        from pyspark.sql import functions as F
        for name in ("row", "key", "n", "component", "risk", "kept", "ids", "h", "_source", "_n", "stratum", "a.b", "c`d"):
            table = table.withColumn(name, F.lit("clash"))
    return table
