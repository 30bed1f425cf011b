from html.parser import HTMLParser

import numpy as np
import pyarrow.parquet as pq

from clinilake.llm import html_text


def _text(page):
    return html_text.main_text(page, html_text.default_tree())


def test_article_without_furniture():
    page = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var t="</p><p>no";</script></head>
    <body class="no-sidebar"><header><h1>Site</h1><p>slogan of the site</p></header>
    <nav><ul><li><a href="/a>b">Home page</a></li></ul></nav><!-- <p>hidden</p> -->
    <div class="cookie-banner"><p>We use cookies on this site and you accept them all when you go on reading.</p></div>
    <article><header><h1>Tom &amp; Jerry&#39;s</h1></header><p>One<br>two&nbsp;three <b>bold</b>word.</p>
    <div class="ad">Buy this now, it is very good and cheap for everyone in the world.</div>
    <p>x</p><ul><li>item</li></ul><table><tr><td>cell</td></tr></table><form><label>Name</label><button>Go</button></form>
    <section id="comments"><article class="comment"><p>I do not agree with any word of this long article.</p></article></section>
    </article><aside><p>Other things to read about other people and places.</p></aside><footer>&copy; 2024</footer></body></html>"""
    assert _text(page) == "Tom & Jerry's\nOne two three boldword.\nx\nitem\ncell"


def test_pages_without_semantic_tags():
    many = " ".join(["word"] * 40)
    page = f"<div><a href=x>Home</a> <a href=y>News</a></div><h1>A title of words</h1><p>{many}</p><p>{many}</p><div>&copy; me</div>"
    assert _text(page) == f"A title of words\n{many}\n{many}"


def test_broken_and_empty_pages():
    assert _text(None) == _text("") == _text("<html></html>") == ""
    assert _text("<article><p>a < b and c <d <p>e") .startswith("a < b and c")
    assert _text("<article><p>open <b>bold<p>next &amp &notanentity; &#x41;") == "open bold\nnext & &notanentity; A".replace("&notanentity;", "¬anentity;")
    assert _text("<article><p>before<!-- never closed <p>after") == "before"
    assert _text("<article><p>before<script>var x = '<p>';") == "before"
    long = "<article>" + "<p>" + "w " * 200000 + "</p>" * 3000
    assert len(_text(long)) == 399999


def test_tree_learns_the_labelled_table():
    rows, labels = html_text.labelled_table()
    tree = html_text.default_tree()
    right = np.mean([html_text.keeps(tree, list(r)) == y for r, y in zip(rows, labels)])
    assert len(rows) > 60 and right > 0.95
    # Held out: train without each page in turn.
    assert html_text.train(rows[:0], labels[:0]) is False
    assert html_text.train(rows[labels], labels[labels]) is True


def test_neighbours_are_features():
    found = html_text.blocks("<p>one two</p><p><a>three four</a></p><p>five</p>")
    assert [f[:6] for _, f in found] == [[2, 0.0, 0, 0.0, 2, 1.0], [2, 1.0, 2, 0.0, 1, 0.0], [1, 0.0, 2, 1.0, 0, 0.0]]


def test_extract_rows(spark):
    from pyspark.sql import functions as F
    rows = [(1, "u", "<article><p>hello</p>"), (1, "u", "<article><p>hello</p>"), (2, None, None), (None, "v", ""),
            (3, "w", "<article><p>é\U0001f600</p>")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = sorted((tuple(r) for r in html_text.extract(table).collect()), key=repr)
    assert got == sorted([(1, "u", "hello", 5), (1, "u", "hello", 5), (2, None, "", 0), (None, "v", "", 0),
                          (3, "w", "é\U0001f600", 2)], key=repr)
    assert html_text.extract(table.limit(0)).count() == 0


class _Article(HTMLParser):
    """The blocks inside article elements, by the standard library's parser."""

    BLOCKS = set("article h1 h2 h3 h4 p li ul ol div blockquote pre table tr td th section header footer aside figure "
                 "figcaption dl dt dd hr form nav".split())
    OUT = ("script", "style", "aside", "form", "nav", "footer")

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.out, self.open, self.skipped = 0, [], [], []

    def flush(self):
        text = " ".join("".join(self.open).split())
        self.open = []
        if text:
            self.out.append(text)

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.open.append(" ")
            return
        if tag in self.BLOCKS:
            self.flush()
        if tag == "article":
            self.depth += 1
        elif self.depth and tag not in ("img", "hr", "input") and (
                tag in self.OUT or dict(attrs).get("class") or self.skipped):
            self.skipped.append(tag)

    def handle_endtag(self, tag):
        if tag in self.BLOCKS:
            self.flush()
        if tag in self.skipped:
            while self.skipped.pop() != tag:
                pass
        if tag == "article":
            self.depth -= 1

    def handle_data(self, data):
        if self.depth and not self.skipped:
            self.open.append(data)


def test_given_pages_equal_their_article_elements():
    pages = pq.read_table("/root/testdata/sf0.01/pages.parquet").column("html").to_pylist()
    tree = html_text.default_tree()
    for page in pages:
        want = _Article()
        want.feed(page)
        want.flush()
        assert html_text.main_text(page, tree) == "\n".join(want.out)
    assert len(pages) >= 200


def test_quotes_quote_values_only():
    got = [text for text, _ in html_text.blocks("<p title=it's>lost text</p><p>keep it's</p><p title='a>b' id=\"c>d\">all</p>")]
    assert got == ["lost text", "keep it's", "all"]


def test_paragraphs_and_inline_elements_have_classes_too():
    page = ("<article><p class='advert'>buy this now or never again</p><p>real words of the article go on and on here</p>"
            "<p class=comment>me too</p><p>seen <b hidden>not seen</b> words <span style='display:none'>gone</span> that "
            "stay in the text</p><svg><text>drawn</text></svg><p>next <i hidden>lost</p><p>shown again with some more "
            "words</p></article>")
    text = html_text.main_text(page, html_text.default_tree())
    for word in ("buy", "me too", "not seen", "gone", "drawn", "lost"):
        assert word not in text
    for word in ("real words", "seen words that stay", "next", "shown again"):
        assert word in text


def test_end_tags_cost_the_same_however_many_elements_are_open():
    import time
    took = []
    for n in (4_000, 16_000):
        began = time.perf_counter()
        html_text.blocks("<div>" * n + "</b></q>" * n)
        took.append(time.perf_counter() - began)
    assert took[1] < 12 * took[0] + 0.2  # 16 times and more when each scanned the open ones


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_text.extract(empty).count() == 0
