"""URL filters: host rules, and association rules mined from labels.

1. A URL's host and path come from its text; a rule such as ``example.net/en/``
   fits its host, all subdomains, and paths that start with its own.  The
   longest rule that fits decides.
2. Where none fits, mined rules decide.  A URL's tokens are its host's labels,
   the words of its path (numbers are one token) and those of its query and
   fragment, each marked with its part.  Spark's FP-growth mines the token
   combinations of unwanted labelled URLs; those of at most :data:`RULE_TOKENS`
   tokens are counted over *all* labelled URLs, and stay with enough support and
   confidence.  A combination that holds a smaller kept one is left out: it
   can match nothing more.
3. Kept rules are an inverted index by their rarest token.  A URL's tokens look
   up the rules, and a rule matches if the URL has all of its tokens.  Any match
   blocks.

Bounds of the fit (documented parameters): a token or combination needs
:func:`least_support` unwanted URLs, and each labelled URL brings its
:data:`ITEMS` most telling tokens to the mining, so that the combinations stay at
most 2**ITEMS for each share of support.  Counting, matching and
the host rules take all tokens of all URLs.

Defined results: a null URL, or one without ``://``, has an empty host and
path, no rule, and is allowed; repeated rows are judged alike, each labelled one
counts; a number with several labels is unwanted if one of them says so; too few
labels mine nothing; empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import combinations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, stored

# Host rules and their verdicts.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}

#: Least support: so many unwanted URLs, and such a share of them.
SUPPORT, SUPPORT_SHARE = 5, 0.001
#: Least percentage of unwanted among the labelled URLs that a rule matches.
CONFIDENCE = 50
#: Tokens of a URL that are mined, tokens of a rule at most.
ITEMS, RULE_TOKENS = 12, 3

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(.*)$"
#: The number of a page's document: the last part of its path, a file ending aside.
_NUMBER = r"/([0-9]{1,18})(\.[a-z]+)?/?$"


def host(url: Column) -> Column:
    """After the first ``://`` up to the path, A-Z lower-cased; else empty."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1))


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def document_number(url: Column) -> Column:
    """The number that ends the path, or null."""
    found = F.regexp_extract(path(url), _NUMBER, 1)
    return F.when(found != "", found.try_cast("long"))


def rule_for(host_name: Column, path_name: Column, rules: dict[str, str] = RULES) -> Column:
    """The longest rule that fits, or null."""
    def fits(rule: str) -> Column:
        name, slash, rest = rule.partition("/")
        return ((host_name == name) | F.endswith(host_name, F.lit("." + name))) & F.startswith(
            path_name, F.lit(slash + rest))

    ordered = sorted(rules, key=lambda r: (-len(r), r))
    return F.coalesce(*[F.when(fits(r), F.lit(r)) for r in ordered])


def tokens(url: Column) -> Column:
    """The distinct tokens of a URL, sorted."""
    text = F.coalesce(url, F.lit(""))
    cut = {"h:": (F.regexp_extract(text, _PARTS, 1), r"\."), "p:": (F.regexp_extract(text, _PARTS, 2), "[/._-]"),
           "q:": (F.regexp_extract(text, _PARTS, 3), "[?#&=]")}

    def marked(mark: str, part: Column, between: str) -> Column:
        named = F.filter(F.split(ascii_lower(part), between), lambda x: x != "")
        return F.transform(named, lambda x: F.concat(
            F.lit(mark), F.when(x.rlike("^[0-9]+$"), F.lit("#")).otherwise(x)))

    return F.array_sort(F.array_distinct(F.concat(*[marked(m, p, b) for m, (p, b) in cut.items()])))


def least_support(n_bad: int) -> int:
    """Unwanted URLs that a token or combination needs."""
    return max(SUPPORT, math.ceil(SUPPORT_SHARE * n_bad))


def labelled(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(row, tokens, bad) of the pages whose document has a label."""
    known = labels.where("doc_id is not null and (quality is not null or toxic is not null)").groupBy(
        F.col("doc_id").alias("number")).agg(
        F.max((F.coalesce(F.col("quality"), F.lit(1)) <= 0) | (F.coalesce(F.col("toxic"), F.lit(0)) > 0)).alias("bad"))
    found = pages.select(tokens(F.col("url")).alias("tokens"), document_number(F.col("url")).alias("number")).join(
        known, "number")
    return found.select(F.monotonically_increasing_id().alias("row"), "tokens", "bad")


def _combinations(items: Column, size: int) -> list[Column]:
    """All proper subsets of an array of that size, as arrays in its order."""
    return [F.array(*[F.get(items, F.lit(i)) for i in chosen])
            for k in range(1, size) for chosen in combinations(range(size), k)]


def mine(rows: DataFrame) -> DataFrame:
    """(tokens, n_bad, n, key) of the kept rules, from (row, tokens, bad).

    The number of unwanted rows and the tokens of enough support (at most
    tokens of a URL / SUPPORT_SHARE) are all that the driver sees, inside FP-growth.
    """
    nothing = rows.limit(0).select("tokens", F.lit(0).cast("long").alias("n_bad"), F.lit(0).cast("long").alias("n"),
                                   F.lit("").alias("key"))
    least = least_support(rows.agg(F.count_if("bad")).first()[0])
    exploded = rows.select("row", "bad", F.explode("tokens").alias("token"))
    counts = stored(exploded.groupBy("token").agg(F.count_if("bad").alias("n_bad"), F.count(F.lit(1)).alias("n"))
                    .where(F.col("n_bad") >= least), "tokens")
    telling = F.struct((-F.col("n_bad") / F.col("n")).alias("share"), (-F.col("n_bad")).alias("count"), "token")
    baskets = stored(exploded.where("bad").join(counts, "token").groupBy("row").agg(
        F.slice(F.sort_array(F.collect_list(telling)), 1, ITEMS)["token"].alias("items")), "baskets")
    n_baskets = baskets.count()
    if n_baskets < least:
        return nothing
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / n_baskets, minConfidence=1.0).fit(baskets)
    mined = stored(model.freqItemsets.where(F.size("items") <= RULE_TOKENS)
                   .select(F.array_sort("items").alias("tokens")), "mined")

    # The rarest token of each combination is its place in the inverted index.
    index = stored(mined.select("tokens", F.explode("tokens").alias("token")).join(counts, "token")
                   .groupBy("tokens").agg(F.min_by("token", F.struct("n", "token")).alias("key")), "index")
    sure = stored(
        _matches(rows, index).groupBy("rule").agg(F.count_if("bad").alias("n_bad"), F.count(F.lit(1)).alias("n"))
        .where((F.col("n_bad") >= least) & (100 * F.col("n_bad") >= CONFIDENCE * F.col("n")))
        .select(F.col("rule").alias("tokens"), "n_bad", "n"), "sure")
    smaller = reduce(DataFrame.unionByName, [
        sure.where(F.size("tokens") == k).select("tokens", F.explode(F.array(*_combinations(F.col("tokens"), k))).alias("part"))
        for k in range(2, RULE_TOKENS + 1)])
    larger = smaller.join(sure.select(F.col("tokens").alias("part")), "part", "left_semi").select("tokens").distinct()
    return sure.join(larger, "tokens", "left_anti").join(index, "tokens")


def _matches(rows: DataFrame, index: DataFrame) -> DataFrame:
    """The rows' columns and each rule that matches, looked up by its key."""
    rules = index.select(F.col("tokens").alias("rule"), F.col("key").alias("token"))
    return (rows.withColumn("token", F.explode("tokens")).join(rules, "token")
            .where(F.size(F.array_except("rule", "tokens")) == 0).drop("token"))


def judge(pages: DataFrame, labels: DataFrame, rules: dict[str, str] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of ``pages``."""
    parted = pages.select("page_id", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    ruled = parted.withColumn("rule", rule_for(F.col("host"), F.col("path"), rules))
    index = stored(mine(stored(labelled(pages, labels), "labelled")), "rules")
    # Distinct URLs that no host rule fits; repeated ones are looked up once.
    open_urls = ruled.where("rule is null and url is not null").select("url").distinct()
    matched = _matches(open_urls.select("url", tokens(F.col("url")).alias("tokens")), index).select("url").distinct()
    given = F.coalesce(*[F.when(F.col("rule") == rule, F.lit(verdict)) for rule, verdict in rules.items()])
    return (ruled.join(matched.withColumn("mined", F.lit(True)), "url", "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce(given, F.when(F.col("mined"), F.lit("block")), F.lit("allow")).alias("verdict")))
