"""Main text of HTML pages: flat blocks, neighbours, a small decision tree.

A page is cut into flat text blocks at block-level tags.  Each block has its
word count and link density, those of the block before and after it, and what
encloses it (an article, a page's furniture such as menus, forms or comments,
a heading).  A decision tree, trained on a small table of labelled blocks,
keeps or drops each block; what is kept is joined by line feeds, in page order.

The labelled table comes from the small pages in ``LABELLED_PAGES``; training
takes milliseconds on the driver and does not depend on the corpus.  Pages are
independent, so a page costs one pass over its tags and nothing shuffles.

Defined results: a null page, or one whose blocks are all dropped, gives an
empty text; character references are decoded once in each text node; white
space (``<br>`` too) inside a block becomes one space; a tag or comment that is
never closed ends with the page; rows that repeat each get a row; null ids and
addresses are kept; extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names of HTML elements.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav "
    "ol option p pre section select summary table tbody td tfoot th thead title tr ul".split())
RAW_TAGS = frozenset("script style textarea title noscript template iframe noembed noframes xmp".split())
FURNITURE_TAGS = frozenset(
    "head nav aside footer form menu dialog button select fieldset legend svg object audio video canvas".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words of class, id and role names.
FURNITURE_WORDS = frozenset(
    "ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs consent cookie cookies disqus "
    "footer masthead menu modal nav navbar navigation newsletter notice notification paywall popup promo promoted "
    "promotion recommended related search share sharing sidebar signup skip social sponsor sponsored subscribe "
    "tags toolbar widget".split())
COMMENT_WORDS = frozenset("comment comments commentlist discussion replies reply respond".split())
MAIN_WORDS = frozenset("articlebody entry maincontent post story".split())
LAYOUT_WORDS = frozenset("container has layout no page site with wrap wrapper".split())

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)>?"
    r"|<[!?][^>]*+>?", re.S)
_NAMED = re.compile(r"""(?:^|[\s"'])(?:class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|[\s"'])hidden(?:[\s=/]|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

FEATURES = ("words", "link_density", "words_before", "links_before", "words_after", "links_after",
            "in_main", "in_furniture", "heading", "page_has_main", "item")


class _Region:
    """What encloses a block: in the main part, in furniture (held: for good), not shown (silent)."""

    __slots__ = ("name", "main", "furniture", "held", "silent")

    def __init__(self, name: str, main: bool, furniture: bool, held: bool, silent: bool = False) -> None:
        self.name, self.main, self.furniture, self.held, self.silent = name, main, furniture, held, silent


def _entered(name: str, rest: str, outer: _Region) -> _Region:
    main, furniture, held = outer.main, outer.furniture, outer.held
    named: set[str] = set()
    if rest:
        for value in _NAMED.findall(rest):
            for one in value.strip("\"'").split():
                parts = {w.lower() for w in _WORDS.findall(one)}
                if not parts & LAYOUT_WORDS:
                    named |= parts
    if named & COMMENT_WORDS or name in FURNITURE_TAGS or (rest and _HIDDEN.search(rest)):
        furniture = held = True
    elif name in ("article", "main") or named & MAIN_WORDS:
        main, furniture = True, held
    elif name == "header":
        furniture = furniture or not main
    elif name not in ("html", "body") and named & FURNITURE_WORDS:
        furniture = True
    return _Region(name, main, furniture, held)


def blocks(page: str) -> list[tuple[str, list[float]]]:
    """The flat text blocks of a page, with their features (see ``FEATURES``)."""
    found: list[list] = []
    stack = [_Region("", False, False, False)]
    opened: Counter[str] = Counter()  # names on the stack: an end tag without a start costs nothing
    paragraph: _Region | None = None  # of the last <p>, which may go without an end
    silent = 0  # open inline elements that are not shown
    text: list[str] = []
    linked: list[str] = []
    kind, in_link, has_main, at, size = "", False, False, 0, len(page)

    def flush() -> None:
        words = " ".join(text).split() if len(text) > 1 else (text[0].split() if text else [])
        if words:
            own = " ".join("".join(text).split())
            links = len(" ".join(linked).split())
            n = len(own.split())
            region = paragraph or stack[-1]
            found.append([own, n, min(1.0, links / n), region.main, region.furniture, kind])
        text.clear()
        linked.clear()

    def shown() -> None:
        """A block begins or ends: inline elements that hide their text are over."""
        nonlocal silent
        if silent:
            silent = 0
            for region in stack:
                region.silent = False

    while at < size:
        start = page.find("<", at)
        token = _TOKEN.match(page, start) if start >= 0 else None
        end = start if start >= 0 else size
        if start >= 0 and token is None:
            end = start + 1  # a bare sign is text
        if end > at and not silent:
            node = html.unescape(page[at:end])
            text.append(node)
            if in_link:
                linked.append(node)
        if token is None:
            at = end
            continue
        at = token.end()
        name = token["name"]
        if name is None:
            continue
        name = name.lower()
        if token["end"]:
            if name in BLOCK_TAGS:
                flush()
                shown()
                paragraph = None
            if name == "a":
                in_link = False
            if opened[name]:
                while len(stack) > 1:
                    left = stack.pop()
                    opened[left.name] -= 1
                    silent -= left.silent
                    if left.name == name:
                        break
            continue
        rest = token["rest"]
        if name in RAW_TAGS:
            if name in BLOCK_TAGS:
                flush()
            close = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
            if close is None and name in ("title", "textarea", "noscript"):
                continue
            at = close.start() if close else size
            continue
        if name in BLOCK_TAGS:
            flush()
            shown()
            kind, paragraph = name, None
        if name == "br":
            text.append(" ")
        elif name == "a":
            in_link = True
        if name == "p" and rest:
            paragraph = _entered(name, rest, stack[-1])
            has_main = has_main or (paragraph.main and not paragraph.furniture)
        if name in VOID_TAGS or name == "p" or rest.endswith("/"):
            continue
        if name in BLOCK_TAGS or name in FURNITURE_TAGS or name in ("span", "ins"):
            if name == "body":  # an open head ends here
                del stack[1:]
                opened.clear()
                silent = 0
            region = _entered(name, rest, stack[-1])
            region.silent = name not in BLOCK_TAGS and (
                name in FURNITURE_TAGS or bool(rest) and _HIDDEN.search(rest) is not None)
            stack.append(region)
            opened[name] += 1
            silent += region.silent
            has_main = has_main or (region.main and not region.furniture)
        elif rest and _HIDDEN.search(rest):
            stack.append(_Region(name, stack[-1].main, stack[-1].furniture, stack[-1].held, True))
            opened[name] += 1
            silent += 1
    flush()
    out = []
    for k, (own, n, links, main, furniture, tag) in enumerate(found):
        before = found[k - 1][1:3] if k else (0, 0.0)
        after = found[k + 1][1:3] if k + 1 < len(found) else (0, 0.0)
        out.append((own, [n, links, *before, *after, float(main), float(furniture), float(tag in HEADINGS),
                          float(has_main), float(tag in ("li", "td", "th", "dt", "dd", "option"))]))
    return out


# The labelled table, as small pages: blocks that begin with + are main text,
# those with - are not; {n} stands for n words.
LABELLED_PAGES = (
    "<body><nav><ul><li><a>- {1}</a><li><a>- {2}</a></ul></nav><article><h1>+ {6}</h1><p>+ {40}<p>+ {3}<p>+ {90}"
    "</article><footer>- {8}</footer></body>",
    "<body><div class='ad'>- {30}</div><article><h1>+ {2}</h1><p>+ {1}</p><p>+ {12} <a>{4}</a></p><ul><li>+ {5}"
    "<li>+ {9}</ul></article><aside><p>- {60}</p></aside><footer><p>- {25}</p></footer></body>",
    "<body><header><h1>- {3}</h1><p>- {14}</p></header><main><h2>+ {5}</h2><p>+ {70}</p><div class='ad'>- {22}</div>"
    "<p>+ {2}</p></main><form><p>- {20}</p></form><div class='notice'><p>- {33}</p></div></body>",
    "<body><div class='cookie-notice'>- {45}</div><article><p>+ {55}</p><blockquote>+ {17}</blockquote>"
    "<p><a>+ {3}</a></p></article><section class='comments'><article><p>- {28}</p></article><p>- {2}</p></section>",
    "<body><article><p>+ {4}</p><table><tr><td>+ {1}<td>+ {2}</table></article><div>- {50}</div><p>- {35}</p></body>",
    "<body><div><a>- {1}</a> <a>{1}</a> <a>{2}</a></div><h1>+ {7}</h1><p>+ {60}</p><p>+ {45}</p><p>+ {30}"
    " <a>{3}</a></p><div><a>- {2}</a></div><div>- {4}</div></body>",
    "<body><ul><li><a>- {2}</a><li><a>- {1}</a><li><a>- {3}</a></ul><div>+ {80}</div><div>+ {25}</div><div>+ {50}</div>"
    "<div><a>- {9}</a></div><p>- {5} <a>{4}</a></p></body>",
    "<body><div class='sidebar'><p>- {40}</p></div><p>+ {66}</p><h2>+ {4}</h2><p>+ {38}</p><p>- {6}</p></body>",
    "<body><h1>+ {5}</h1><p>+ {20}</p><p>+ {24}</p><p>+ {100}</p></body>",
    "<body><p>- {3}</p><div><a>- {4}</a></div><p>- {2}</p></body>",
    "<body><article><aside>- {12}</aside><h2>+ {2}</h2><p>+ {8}</p><form>- {3}</form></article><p>- {70}</p>"
    "<h2>- {3}</h2><ul><li>- {20}</ul></body>",
)


def labelled_table() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the blocks of ``LABELLED_PAGES``."""
    rows, labels = [], []
    for page in LABELLED_PAGES:
        filled = re.sub(r"\{(\d+)\}", lambda m: " ".join(["word"] * int(m[1])), page)
        for own, features in blocks(re.sub(r"([+-]) ", r"\1", filled)):
            labels.append(own.startswith("+"))
            rows.append(features)
    return np.array(rows, float), np.array(labels, bool)


def train(rows: np.ndarray, labels: np.ndarray, depth: int = 6, least: int = 2) -> tuple | bool:
    """A decision tree by Gini impurity: (feature, limit, at most, above) or a label."""
    share = labels.mean() if len(labels) else 0.0
    if depth == 0 or share in (0.0, 1.0):
        return bool(share >= 0.5)
    best = None
    for f in range(rows.shape[1]):
        for limit in np.unique(rows[:, f])[:-1]:
            low = rows[:, f] <= limit
            n = low.sum()
            if least <= n <= len(low) - least:
                a, b = labels[low].mean(), labels[~low].mean()
                impurity = (n * a * (1 - a) + (len(low) - n) * b * (1 - b)) / len(low)
                if best is None or impurity < best[0] - 1e-12:
                    best = (impurity, f, limit, low)
    if best is None or best[0] >= share * (1 - share) - 1e-12:
        return bool(share >= 0.5)
    _, f, limit, low = best
    above = np.unique(rows[:, f])
    middle = float((limit + above[np.searchsorted(above, limit, "right")]) / 2)
    return f, middle, train(rows[low], labels[low], depth - 1, least), train(rows[~low], labels[~low], depth - 1, least)


@lru_cache(maxsize=1)
def default_tree() -> tuple | bool:
    return train(*labelled_table())


def keeps(tree: tuple | bool, features: list[float]) -> bool:
    while not isinstance(tree, bool):
        f, limit, low, high = tree
        tree = low if features[f] <= limit else high
    return tree


def main_text(page: str | None, tree: tuple | bool) -> str:
    return "\n".join(own for own, features in blocks(page or "") if keeps(tree, features))


def _extracting(tree: tuple | bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                texts = [main_text(p.as_py(), tree) for p in part.column("html")]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])
    return run


def extract(pages: DataFrame, tree: tuple | bool | None = None) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars (code points)."""
    given = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.col("html").cast("string").alias("html"))
    return given.mapInArrow(_extracting(default_tree() if tree is None else tree),
                            "page_id long, url string, text string, n_chars long")
