"""URL filters: parts and rules by hand, mined rules against a brute force."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from clinilake.llm import url_rules as u

PAGES = "page_id long, url string"
LABELS = "doc_id long, quality int, toxic int"


def _labels(spark, rows=()):
    return spark.createDataFrame(list(rows), LABELS)


@pytest.mark.parametrize("url, host, path, rule", [
    ("http://Blog.Example.NET/en/5?x=/", "blog.example.net", "/en/5", "example.net/en/"),
    ("https://example.net/EN/", "example.net", "/EN/", "net/"),
    ("x://net/", "net", "/", "net/"),
    ("x://net", "net", "", None),
    ("x://a.net?q=/", "a.net", "", None),
    ("x://anet/", "anet", "/", None),
    ("x://notexample.net/en/", "notexample.net", "/en/", "net/"),
    ("x://example.com/de/1", "example.com", "/de/1", "example.com/de/"),
    ("x://a.b.example.com/de", "a.b.example.com", "/de", None),
    ("x://org/fr/#a", "org", "/fr/", "org/fr/"),
    ("x://É.ORG/fr/\n", "É.org", "/fr/\n", "org/fr/"),
    ("a://b://c.net/", "b:", "//c.net/", None),
    ("//a.net/", "", "", None), ("", "", "", None), (None, "", "", None), ("://", "", "", None),
])
def test_parts_and_rules(spark, url, host, path, rule):
    got = u.judge(spark.createDataFrame([(1, url)], PAGES), _labels(spark)).first()
    assert (got.host, got.path, got.rule) == (host, path, rule)
    assert got.verdict == (u.RULES[rule] if rule else "allow")


def _tokens(url):
    import re
    found = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)(.*)$", url or "")
    if not found:
        return set()
    cut = (("h:", r"\."), ("p:", "[/._-]"), ("q:", "[?#&=]"))
    return {m + ("#" if re.fullmatch("[0-9]+", x) else x) for (m, b), part in zip(cut, found.groups())
            for x in re.split(b, part.lower()) if x}


def _brute(pages, labels):
    import re
    bad_of = {}
    for doc, q, t in labels:
        if doc is not None and (q is not None or t is not None):
            bad = (q if q is not None else 1) <= 0 or (t or 0) > 0
            bad_of[doc] = bad_of.get(doc, False) or bad
    known = []
    for _, url in pages:
        found = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)(.*)$", url or "")
        number = re.search(r"/([0-9]{1,18})(\.[a-z]+)?/?$", found.group(2)) if found else None
        if number and int(number.group(1)) in bad_of:
            known.append((_tokens(url), bad_of[int(number.group(1))]))
    least = u.least_support(sum(b for _, b in known))
    kept = set()
    for size in range(1, u.RULE_TOKENS + 1):
        for combo in {x for ts, b in known if b for x in combinations(sorted(ts), size)}:
            hits = [b for ts, b in known if set(combo) <= ts]
            if sum(hits) >= least and 100 * sum(hits) >= u.CONFIDENCE * len(hits):
                kept.add(combo)
    return kept


def _planted(seed=2):
    """Bad pages share a host word and a path word that are harmless apart."""
    rng = random.Random(seed)
    pages, labels = [], []
    for i in range(600):
        host, part = rng.choice(["shop", "news", "wiki"]), rng.choice(["win", "read", "list"])
        end = rng.choice(["", ".html", "/"])
        pages.append((i, f"http://{host}.example.com/{part}/{i}{end}{rng.choice(['', '?ref=x', '#top'])}"))
        bad = host == "shop" and part == "win"
        if rng.random() < 0.6:
            labels.append((i, int(not bad), 0) if rng.random() < 0.5 else (i, None, int(bad)))
    return pages, labels


def test_mined_rules_equal_brute_force(spark):
    pages, labels = _planted()
    rules = u.mine(u.stored(u.labelled(spark.createDataFrame(pages, PAGES), _labels(spark, labels)), "labelled"))
    got = {tuple(r.tokens) for r in rules.collect()}
    want = _brute(pages, labels)
    # Kept: the wanted ones that hold no smaller one.
    assert got == {x for x in want if not any(set(y) < set(x) for y in want)}
    assert ("h:shop", "p:win") in got
    verdicts = {r.page_id: r.verdict for r in u.judge(spark.createDataFrame(pages, PAGES), _labels(spark, labels)).collect()}
    assert verdicts == {i: "block" if any(set(x) <= _tokens(url) for x in want) else "allow" for i, url in pages}
    assert {i for i, url in pages if "shop" in url and "/win/" in url} == {i for i, v in verdicts.items() if v == "block"}


def test_rules_win_over_mined_ones(spark):
    pages, labels = _planted()
    pages = [*pages, (1000, "http://shop.org/fr/win/9"), (1001, "http://shop.example.com/de/win/9"), (1002, None)]
    got = {r.page_id: (r.rule, r.verdict) for r in u.judge(spark.createDataFrame(pages, PAGES), _labels(spark, labels)).collect()}
    assert got[1000] == ("org/fr/", "allow") and got[1001] == ("example.com/de/", "block") and got[1002] == (None, "allow")


def test_a_long_url_in_many_rows_mines_in_bounds(spark):
    """A third of the rows share a URL of 400 tokens: 2**400 combinations, 12 mined."""
    long = "http://bad.example.com/" + "/".join(f"w{i}x" for i in range(400))
    pages = [(i, f"{long}/{i}") for i in range(40)] + [(i, f"http://ok.example.com/a/{i}") for i in range(40, 120)]
    labels = [(i, int(i >= 40), 0) for i in range(120)]
    got = {r.page_id: r.verdict for r in u.judge(spark.createDataFrame(pages, PAGES), _labels(spark, labels)).collect()}
    assert got == {i: "block" if i < 40 else "allow" for i in range(120)}


def test_few_labels_empty_tables_repeats_and_clashes(spark):
    pages = spark.createDataFrame([(1, "x://a.com/1"), (1, "x://a.com/1"), (None, "x://a.com/2"), (2, None)], PAGES)
    for name in ("host", "path", "rule", "verdict", "tokens", "row", "bad", "mined", "token", "a.b", "number"):
        pages = pages.withColumn(name, F.lit("clash"))
    for labels in (_labels(spark), _labels(spark, [(1, 0, 1), (None, 0, 0), (2, None, None)])):
        got = u.judge(pages, labels.withColumn("tokens", F.lit(1)).withColumn("url", F.lit("x")))
        assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
        assert sorted((r.page_id or 0, r.verdict) for r in got.collect()) == [
            (0, "allow"), (1, "allow"), (1, "allow"), (2, "allow")]
    assert u.judge(pages.limit(0), _labels(spark)).count() == 0


def test_no_python_on_the_way(spark):
    from conftest import plan_text
    pages, labels = _planted()
    text = plan_text(u.judge(spark.createDataFrame(pages, PAGES), _labels(spark, labels)))
    assert "Python" not in text and "Arrow" not in text and "Cartesian" not in text and "NestedLoop" not in text
