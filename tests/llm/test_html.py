"""Main text of pages: the given pages' articles, other layouts, and the decoding by brute force."""

import html as entities
import itertools
import re

import numpy as np
import pytest

from assaymill.llm import html, queries
from assaymill.llm.boosting import Trees

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def trees(spark):
    return html.fit(spark.read.parquet(f"{SF}/pages.parquet"), max_pages=60)


def article(page):
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", inner.replace("<br>", " ")))
    return "\n\n".join(t for t in (" ".join(entities.unescape(p).split()) for p in parts) if t)


def test_given_pages_give_their_articles(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = queries.QUERIES["op5_html_text"](spark, SF).collect()
    assert len(got) == len(pages)
    right = [r["text"] == article(pages[r["page_id"]]["html"]) and r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"] for r in got]
    assert np.mean(right) > 0.99


OTHER = """<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header><div class="menu"><a href=x>Home</a><a>About</a></div>
<div class="cookie-notice">We use cookies</div><div id="content"><h2>Title &eacute;</h2><p>Para one is long enough, with   text. And more words here.<p>Para two
<ul><li>item a<li>item b</ul><script>var x = "</p>"</script><div class="ad">Buy now</div><table><tr><td>c1<td>c2</table><!-- no --><blockquote>Quote it</blockquote></div>
<aside class="sidebar"><p>Related things here</p></aside><section class="comments"><p>Nice post, thanks a lot for it.</p></section>
<form><label>Email</label><input></form><footer>c 2020</footer></body></html>"""


def test_another_layout(trees):
    assert html.main_text(OTHER, trees) == "\n\n".join(
        ["Title é", "Para one is long enough, with text. And more words here.", "Para two", "item a", "item b", "c1", "c2", "Quote it"])


def test_tree_of_odd_markup():
    tree = html.Tree("a<p>b<div>c</div></p>d</b></i><br>e<hr>f<p/>g &lt;h&gt; <td>i<a>j")
    assert [t for _, t in tree.blocks()] == ["a", "b", "c", "d e", "f", "g <h>", "ij"]
    assert html.Tree("").blocks() == [] and html.Tree("<" * 5000).blocks() and html.Tree("<div>" * 3000 + "x").blocks()[0][1] == "x"
    assert html.Tree("<p>one<script>no<p>no</script> two").blocks() == [(1, "one two")]


@pytest.mark.parametrize("start", ["<html><head><title>t</title><body>", "<head><title>t</title>", "<title>t</title><body>", "<title>t</title>",
                                   "<head><meta charset=x><style>p{}</style><noscript><img src=x></noscript><title>t</title><body class=y>"])
def test_omitted_tags_of_the_head(trees, start):
    page = start + "<article><h1>Heading</h1><p>The first paragraph, which has some words.<p>The second one, which has more of them.</article>"
    want = ["Heading", "The first paragraph, which has some words.", "The second one, which has more of them."]
    assert [t for _, t in html.Tree(page).blocks()] == want
    assert html.main_text(page, trees) == "\n\n".join(want)


def test_head_ends_at_text_and_at_elements_of_the_body():
    texts = ["a", "b"]
    for page in ("<head><title>t</title>a<p>b", "<head><p>a<p>b", "<head><img src=x>a<p>b", "<head></head>a<p>b", "<head><svg/>a<p>b",
                 "<head><template><p>x</template><title>t</title><p>a<p>b"):
        assert [t for _, t in html.Tree(page).blocks()] == texts, page


def test_self_closed_svg_and_math_hide_nothing():
    assert [t for _, t in html.Tree("<div>a <svg/> b<p>c <math/> d</p></div><svg><path/><text>no</text></svg>e").blocks()] == ["a b", "c d", "e"]


def test_decoding_is_the_best_consistent_choice():
    rng = np.random.default_rng(3)
    for _ in range(40):
        n = int(rng.integers(1, 8))

        class Small:
            parent = [-1] + [int(rng.integers(0, i)) for i in range(1, n)]
        odds = rng.normal(0, 2, n)

        def score(choice):
            return sum(-np.logaddexp(0, -o) if c else -np.logaddexp(0, o) for c, o in zip(choice, odds, strict=True))
        allowed = [c for c in itertools.product([False, True], repeat=n) if all(not c[i] or c[Small.parent[i]] for i in range(1, n))]
        assert score(html.kept_blocks(Small, odds)) == pytest.approx(max(map(score, allowed)))


def test_boosting_learns_a_rule():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] < -0.2)).astype(float)
    trees = Trees(depth=3, rounds=30).fit(x[:1500], y[:1500], np.ones(1500))
    assert np.mean((trees.log_odds(x[1500:]) > 0) == y[1500:]) > 0.95


def test_odd_rows(spark, trees):
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (None, "u", OTHER, "x"), (3, "u", "<p>" + "word " * 50_000, "x"), (3, "u", OTHER, "x"), (3, "u", OTHER, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html.extract(df, trees).collect()
    assert len(got) == len(rows) and got[0].asDict().keys() == {"page_id", "url", "text", "n_chars"}
    assert sorted(r["n_chars"] for r in got)[:2] == [0, 0] and max(r["n_chars"] for r in got) == 5 * 50_000 - 1
    assert html.extract(df.limit(0), html.fit(df.limit(0))).count() == 0


def test_long_pages_shape_the_model_and_give_their_articles(spark):
    """All pages of over 200 000 characters: nothing is too long for the sample, and no text is empty."""
    pages, want = [], {}
    for i in range(4):
        body = [f"Sentence {k} of article {i} goes on about things that matter to its readers, and so on." for k in range(2600)]
        menu = "".join(f"<li><a href='/{k}'>Item {k}</a></li>" for k in range(30))
        pages.append((i, f"u{i}", f"<html><head><title>t</title></head><body><nav><ul>{menu}</ul></nav><article><h1>Title {i}</h1>"
                      + "".join(f"<p>{p}</p>" for p in body) + "</article><footer>Copyright words here</footer></body></html>"))
        want[i] = "\n\n".join([f"Title {i}", *body])
    assert min(len(p[2]) for p in pages) > 200_000
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html.extract(df, html.fit(df)).collect()}
    assert got == want


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert html.fit(df) is None and html.extract(df, html.fit(df)).count() == 0
