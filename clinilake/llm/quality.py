r"""Quality rules with risk-controlled cutoffs, Spark expressions only.

Every text gets signals (symbols, repeated lines, repeated word windows,
shouting), each divided by a usual limit; ``risk`` is the largest.  A document
is rejected when its risk exceeds the cutoff of its stratum (language).  The
cutoffs come from labelled documents:

* a cutoff is *safe* for a stratum when the exact binomial tail
  ``P(X <= falsely rejected | n good documents, alpha)`` is at most
  ``delta / strata`` (Bonferroni over strata), so that with probability
  ``1 - delta`` no stratum loses more than ``alpha`` of its good documents;
* within a stratum cutoffs are tested in a fixed order, from mild to strict,
  and testing stops at the first that is not safe, which needs no further
  correction;
* of the safe cutoffs the one with the most bad documents caught less good ones
  lost is taken, the mildest of equals.  A stratum with no safe cutoff rejects nothing.

Defined results: a null text has no words; a null language is a stratum of its
own; labels with a null doc_id or quality, or of unknown documents, are
ignored; repeated labels count once for each row; an empty label table
rejects nothing beyond the base rules.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinilake.operators.joins import fits_broadcast

from .common import UPPER, let, stored, text_or_empty, whole_row, words

SYMBOLS = "#*$%&|<>"
WINDOW = 8
ALPHA = 0.02
DELTA = 0.05
#: The tested cutoffs, from mild to strict.
CUTOFFS = (8.0, 6.0, 4.0, 3.0, 2.0, 1.5, 1.0, 0.8, 0.6)
#: Each signal's usual limit: risk 1 is just there.
LIMITS = {"symbols": 0.1, "dup_lines": 0.8, "repeat_words": 0.6, "upper": 0.3, "bangs": 0.1}


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _repeat_words(tokens: Column) -> Column:
    """Words covered by 8-word windows that occur twice or more in the text.

    Window hashes are compared first; only texts with a repeated one sort
    their windows to find the covered places.
    """
    def covered(hashes: Column) -> Column:
        def places(ordered: Column) -> Column:
            again = F.filter(ordered, lambda s, j: (
                F.coalesce(F.get(ordered, j - 1)["h"] == s["h"], F.lit(False))
                | F.coalesce(F.get(ordered, j + 1)["h"] == s["h"], F.lit(False))))
            return F.array_sort(F.transform(again, lambda s: s["i"]))

        def total(at: Column) -> Column:
            steps = F.transform(at, lambda x, j: F.least(
                F.lit(WINDOW), F.coalesce(F.get(at, j + 1) - x, F.lit(WINDOW))).cast("long"))
            return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

        ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(
            let(ordered, lambda o: let(places(o), total)))

    def windows(hashed: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(hashed) - WINDOW), lambda i: F.xxhash64(
            *[F.get(hashed, i + k) for k in range(WINDOW)]))

    return F.when(F.size(tokens) <= WINDOW, F.lit(0).cast("long")).otherwise(
        let(F.transform(tokens, lambda w: F.xxhash64(w)), lambda h: let(windows(h), covered)))


def signals(text: Column) -> Column:
    """A struct of the base counts and of what the risk needs, for one text."""
    def lines(found: Column) -> Column:
        return F.struct(F.size(found).alias("n"), F.size(F.array_distinct(found)).alias("kinds"))

    def counts(tokens: Column) -> Column:
        worded = F.filter(F.split(text, "\n", -1), lambda s: F.rlike(s, F.lit(r"[^\x20\x09-\x0D]")))
        return F.struct(
            F.size(tokens).cast("long").alias("n_words"),
            F.length(F.array_join(tokens, "")).cast("long").alias("word_chars"),
            _count(text, SYMBOLS).cast("long").alias("n_symbols"),
            let(worded, lines).alias("lines"),
            _repeat_words(tokens).alias("n_repeat_words"),
            _count(text, UPPER).cast("long").alias("n_upper"),
            _count(text, "!").cast("long").alias("n_bangs"))

    return let(words(text), counts)


def measured(documents: DataFrame, keep: list[Column]) -> DataFrame:
    """``keep`` plus n_words, the base counts, base_failed and risk."""
    f = F.col("_signals")

    def share(part: Column, whole: Column, limit: str) -> Column:
        return F.when(whole > 0, part / whole / F.lit(LIMITS[limit])).otherwise(F.lit(0.0))

    found = documents.select(*keep, signals(text_or_empty()).alias("_signals"))
    dup_lines = (f["lines"]["n"] - f["lines"]["kinds"]).cast("long")
    return found.select(
        *[F.col(n) for n in found.columns if n != "_signals"],
        f["n_words"].alias("n_words"), f["word_chars"].alias("word_chars"),
        f["n_symbols"].alias("n_symbols"), dup_lines.alias("n_dup_lines"),
        f["n_repeat_words"].alias("n_repeat_words"),
        ((f["n_words"] < 20) | (100 * f["n_repeat_words"] > 30 * f["n_words"])).alias("base_failed"),
        F.greatest(
            share(f["n_symbols"], f["word_chars"], "symbols"),
            share(dup_lines, f["lines"]["n"], "dup_lines"),
            share(f["n_repeat_words"], f["n_words"], "repeat_words"),
            share(f["n_upper"], f["word_chars"], "upper"),
            share(f["n_bangs"], f["n_words"], "bangs")).alias("risk"))


def _ln_gamma(x: Column) -> Column:
    """Stirling's series eight steps up, then back by the recurrence."""
    y = x + 8
    series = ((y - 0.5) * F.log(y) - y + F.lit(0.9189385332046727)
              + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y))
    down = F.log(x)
    for k in range(1, 8):
        down = down + F.log(x + k)
    return series - down


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Bin(n, p): the exact sum, from its largest term down.

    Meant for k below n * p, where terms fall from k on; the sum is relative
    to the term at k, so that nothing underflows.
    """
    odds = F.lit((1 - p) / p)
    n, k = n.cast("double"), k.cast("double")
    top = (_ln_gamma(n + 1) - _ln_gamma(k + 1) - _ln_gamma(n - k + 1)
           + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p)))
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def step(acc: Column, i: Column) -> Column:
        term = acc["term"] * (k - i + 1) / (n - k + i) * odds
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))

    below = F.filter(F.sequence(F.lit(0).cast("long"), k.cast("long")), lambda i: i > 0)
    total = F.aggregate(below, start, step, lambda acc: acc["sum"])
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.exp(top) * total)


def choose_cutoffs(scored: DataFrame, alpha: float = ALPHA, delta: float = DELTA,
                   cutoffs: tuple[float, ...] = CUTOFFS) -> DataFrame:
    """The safe cutoff of each stratum: stratum, cutoff, n_good, false_rejects, caught.

    ``scored`` has stratum, risk and good (boolean), a row for each label.
    One aggregation over the labels, then a handful of rows for each stratum.
    """
    over = [F.count_if(F.col("good") & (F.col("risk") > c)) for c in cutoffs]
    caught = [F.count_if(~F.col("good") & (F.col("risk") > c)) for c in cutoffs]
    table = scored.groupBy("stratum").agg(
        F.count_if("good").alias("n_good"),
        F.array(*[F.struct(F.lit(i).alias("step"), F.lit(c).alias("cutoff"), k.alias("false_rejects"),
                           b.alias("caught"))
                  for i, (c, k, b) in enumerate(zip(cutoffs, over, caught, strict=True))]).alias("tests"))
    # A row for each stratum, so their count may be taken over all of them at once.
    strata = F.count(F.lit(1)).over(Window.partitionBy(F.lit(1)))
    tested = (
        table.select("stratum", "n_good", strata.alias("strata"), "tests")
        .select("stratum", "n_good", "strata", F.explode("tests").alias("t"))
        .select("stratum", "n_good", "t.*",
                (binomial_tail(F.col("t.false_rejects"), F.col("n_good"), alpha)
                 <= F.lit(delta) / F.col("strata")).alias("safe")))
    so_far = Window.partitionBy("stratum").orderBy("step")
    return (
        tested.withColumn("safe", F.min("safe").over(so_far)).where("safe")
        .groupBy("stratum")
        .agg(F.max_by(F.struct("cutoff", "n_good", "false_rejects", "caught"),
                      F.struct(F.col("caught") - F.col("false_rejects"), -F.col("step"))).alias("best"))
        .select("stratum", "best.*"))


def _labelled(rows: DataFrame, doc_id: Column, stratum: Column, labels: DataFrame) -> DataFrame:
    known = labels.where("doc_id is not null and quality is not null").select(
        F.col("doc_id").alias("label_id"), (F.col("quality") > 0).alias("good"))
    return (rows.select(doc_id.alias("label_id"), stratum.alias("stratum"), "risk")
            .join(known, "label_id").select("stratum", "risk", "good"))


def _judged(rows: DataFrame, stratum: Column, cutoffs: DataFrame) -> DataFrame:
    """Adds cutoff and kept; the cutoffs have a row for each stratum at most."""
    limit = cutoffs.select(F.col("stratum").alias("_stratum"), F.col("cutoff").alias("cutoff"))
    joined = rows.join(F.broadcast(limit), stratum.eqNullSafe(F.col("_stratum")), "left").drop("_stratum")
    return joined.withColumn("kept", ~F.col("base_failed") & (
        F.col("cutoff").isNull() | (F.col("risk") <= F.col("cutoff"))))


def assess(documents: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """One row per row of ``documents``: doc_id, lang, counts, risk, cutoff, kept.

    The counts are made in one scan and stored; labels join them on doc_id
    (both sides shuffle a few numbers a row); texts never shuffle.
    """
    rows = stored(measured(documents, [F.col("doc_id"), F.col("lang")]), "quality")
    cutoffs = choose_cutoffs(_labelled(rows, F.col("doc_id"), F.col("lang"), labels), alpha, delta)
    return _judged(rows, F.col("lang"), cutoffs)


def keep_good(documents: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The rows of ``documents`` that :func:`assess` keeps, with all their columns.

    No text is stored or shuffled: the cutoffs come from the labelled rows' counts
    (a scan whose rows are cut down to the labels' first, where those are shown to
    be few enough to broadcast), the verdicts from a second scan.
    """
    ids = labels.where("doc_id is not null and quality is not null").select(
        F.col("doc_id").alias("_labelled")).distinct()
    asked = documents
    if fits_broadcast(ids):
        asked = documents.join(F.broadcast(ids), F.col("doc_id") == F.col("_labelled"), "left_semi")
    counted = measured(asked, [F.col("doc_id"), F.col("lang")])
    cutoffs = stored(choose_cutoffs(_labelled(counted, F.col("doc_id"), F.col("lang"), labels), alpha, delta), "cutoffs")
    rows = measured(documents, [F.struct(*whole_row(documents)).alias("row")])
    # The same verdict as one comparison with the cutoff: a condition on the counts
    # alone would be pushed below the join, and all texts counted twice.
    risk = F.when(F.col("base_failed"), F.lit(float("inf"))).otherwise(F.col("risk"))
    limit = F.coalesce(F.col("cutoff"), F.lit(sys.float_info.max))
    return _judged(rows, F.col("row.lang"), cutoffs).where(risk <= limit).select("row.*")
