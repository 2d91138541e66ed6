"""Main text of web pages by gradient-boosted trees over DOM nodes, with hierarchical decoding.

A page is parsed to a tree. Each block element gets features: depth, size, text, link and punctuation densities of its subtree, place and
likeness among its siblings, and the meaning of its tag and attribute tokens and of those above it. Boosted trees give the log
odds that a block belongs to the article. Decoding maximises the summed log likelihood over all keep/drop choices in which no
kept block lies in a dropped one, by one pass up and one down the tree.

The trees are fitted on the blocks of at most `max_pages` pages (of the lowest hashes; a documented sample), labelled by
rules on tags and attribute tokens. Each sample page is fitted as it is, with boilerplate of other kinds grafted in, and with its
semantic features masked, so that shape decides where names don't.

Text: character references decoded, white space inside a block made one blank, blocks trimmed, empty ones left out, the rest
joined by an empty line. Null and empty pages have no text. Pages are judged one by one, so repeated rows get equal results; extra
columns are kept, those named like an output column are replaced.
"""

from __future__ import annotations

import random
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaymill.llm import arrowtext, sampling
from assaymill.llm.boosting import Trees

MAX_PAGES = 150
#: Grafted copies of each sample page.
GRAFTS = 3
#: Blocks of a sample page, or of a grafted copy, that the trees are fitted on; texts of a page that are grafted elsewhere, and their length.
MAX_BLOCKS = 400
PAGE_TEXTS = 40
TEXT_CHARS = 2000

ADDED = ["text", "n_chars"]

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Never text of a page.
HIDDEN = frozenset("script style head title noscript template iframe object svg math select textarea".split())
#: What a head may hold; any other tag or text ends one that is open.
IN_HEAD = frozenset("html head base link meta title script style noscript template".split())
BLOCKS = frozenset(
    "html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre "
    "figure figcaption nav header footer aside form fieldset details summary address center hgroup dialog button".split())
#: Elements that a start tag of the key closes, up to the given border.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
BORDERS = frozenset("ul ol dl table body article main section div nav aside header footer form td th".split())

#: What tags and attribute tokens say. Order is the order of features.
MEANINGS = {
    "main": ({"article", "main"}, "article content entry main post story body text"),
    "menu": ({"nav"}, "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc"),
    "header": ({"header", "hgroup"}, "header masthead topbar branding logo"),
    "footer": ({"footer", "address"}, "footer copyright colophon bottom legal"),
    "side": ({"aside"}, "sidebar aside related recommended widget promo teaser trending"),
    "advert": (set(), "ad ads advert adverts advertisement sponsor sponsored banner"),
    "notice": ({"dialog"}, "cookie cookies notice consent gdpr alert popup modal overlay"),
    "form": ({"form", "fieldset", "button"}, "form login search subscribe newsletter signup"),
    "comment": (set(), "comment comments disqus reply replies respond discussion"),
    "share": (set(), "share sharing social follow"),
}
TAG_GROUPS = [{"p"}, {"h1", "h2", "h3", "h4", "h5", "h6"}, {"ul", "ol", "li", "dl", "dt", "dd"}, {"div"}, {"section"},
              {"table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"blockquote", "pre", "figure", "figcaption"}]
N_SHAPE = 16


class Tree(HTMLParser):
    """Block elements of a page in document order, and its text runs by block. Inline elements belong to their block."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.tag, self.tokens, self.parent, self.size = ["html"], [set()], [-1], [0]
        self.runs: list[tuple[int, list[str]]] = [(0, [])]  # (block, strings) between block borders
        self.linked: list[int] = [0]
        self.stack: list[tuple[str, int]] = []  # open elements: (tag, block they are in)
        self.hidden = self.links = 0
        self.found: list[tuple[int, str]] | None = None
        self.feed(html)
        self.close()

    def _block(self) -> int:
        return self.stack[-1][1] if self.stack else 0

    def _border(self) -> None:
        self.runs.append((self._block(), []))

    def _pop(self, to: int) -> None:
        while len(self.stack) > to:
            tag, _ = self.stack.pop()
            self.hidden -= tag in HIDDEN
            self.links -= tag == "a"
            if tag in BLOCKS:
                self._border()

    def _leave_head(self, tag: str) -> None:
        """End a head whose end tag is left out: at what can't be in it, and at the body whatever is open."""
        if tag == "body" or (self.stack and self.stack[-1][0] == "head" and tag not in IN_HEAD):
            at = next((i for i, (open_tag, _) in enumerate(self.stack) if open_tag == "head"), None)
            if at is not None:
                self._pop(at)

    def handle_starttag(self, tag, attrs):
        self._leave_head(tag)
        if tag in VOID:
            if tag == "br":
                self.runs[-1][1].append(" ")
            elif tag == "hr":
                self._border()
            return
        if tag in BLOCKS:
            self._close({"p"}, BORDERS - {"td", "th"})
            self._close(CLOSES.get(tag, ()), BORDERS if tag not in ("tr", "td", "th", "thead", "tbody", "tfoot") else {"table"})
        block = self._block()
        if tag in BLOCKS and not self.hidden:
            if tag == "html" and len(self.tag) == 1:
                self.tokens[0] |= words_of(attrs)
            else:
                block = len(self.tag)
                self.tag.append(tag), self.tokens.append(words_of(attrs)), self.parent.append(self._block()), self.linked.append(0)
        self.stack.append((tag, block))
        self.hidden += tag in HIDDEN
        self.links += tag == "a"
        if tag in BLOCKS:
            self._border()

    def _close(self, tags, borders) -> None:
        """Close the outermost open one of `tags` that no border separates from here."""
        found = None
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] in tags:
                found = i
            if self.stack[i][0] in borders and self.stack[i][0] not in tags:
                break
        if found is not None:
            self._pop(found)

    def handle_startendtag(self, tag, attrs):
        if tag in ("svg", "math"):
            self._leave_head(tag)
        else:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                self._pop(i)
                return
            if tag not in BLOCKS and tag not in HIDDEN and self.stack[i][0] in BLOCKS:
                return

    def handle_data(self, data):
        if self.hidden and data.strip():
            self._leave_head("#text")
        if not self.hidden:
            self.runs[-1][1].append(data)
            if self.links:
                self.linked[self.runs[-1][0]] += len(data.strip())

    def blocks(self) -> list[tuple[int, str]]:
        """(block, text) of each run that has text."""
        if self.found is None:
            every = [(b, " ".join("".join(s).split())) for b, s in self.runs]
            self.found = [(b, t) for b, t in every if t]
        return self.found


def words_of(attrs) -> set[str]:
    """Tokens of the attributes that name a part of a page."""
    values = [v for k, v in attrs if k in ("class", "id", "role", "itemprop", "aria-label") and v]
    return set("".join(c if c.isalnum() else " " for c in " ".join(values).lower()).split())


def meanings(tree: Tree) -> np.ndarray:
    """For each block and meaning, whether its tag or tokens have it."""
    known = [(tags, set(words.split())) for tags, words in MEANINGS.values()]
    return np.array([[tag in tags or not held.isdisjoint(words) for tags, words in known] for tag, held in zip(tree.tag, tree.tokens, strict=True)])


def features(tree: Tree) -> np.ndarray:
    n = len(tree.tag)
    parent = np.array(tree.parent)
    own, marks, paragraphs = np.zeros(n), np.zeros(n), np.zeros(n)
    for b, t in tree.blocks():
        own[b] += len(t)
        marks[b] += sum(t.count(c) for c in ".,;:!?")
        paragraphs[b] += 1
    chars, links, dots, runs, count, depth = own.copy(), np.array(tree.linked, float), marks, paragraphs, np.ones(n), np.zeros(n)
    for i in range(n - 1, 0, -1):  # children come after their parents
        for total in (chars, links, dots, runs, count):
            total[parent[i]] += total[i]
    for i in range(1, n):
        depth[i] = depth[parent[i]] + 1
    up = np.maximum(parent, 0)
    siblings = np.bincount(up[1:], minlength=n) if n > 1 else np.zeros(1)
    index, seen, alike = np.zeros(n), {}, {}
    for i in range(1, n):
        index[i] = seen.get(parent[i], 0)
        seen[parent[i]] = index[i] + 1
        alike[parent[i], tree.tag[i]] = alike.get((parent[i], tree.tag[i]), 0) + 1
    around = np.maximum(siblings[up], 1)
    same = np.array([alike.get((parent[i], tree.tag[i]), 1) for i in range(n)]) / around
    beside = (chars[up] - own[up] - chars) / np.maximum(around - 1, 1)
    shape = np.stack([
        depth, np.arange(n) / n, np.log1p(chars), chars / max(1.0, chars[0]), np.log1p(count), chars / count, np.minimum(links / np.maximum(chars, 1), 1),
        dots / np.maximum(chars, 1), chars / np.maximum(runs, 1), runs, siblings, around, index / around, same, np.log1p(np.maximum(beside, 0)),
        own / np.maximum(chars, 1)], axis=1)
    tags = np.array([[tag in group for group in TAG_GROUPS] for tag in tree.tag], float)
    here = meanings(tree)
    above = here.copy()
    for i in range(1, n):
        above[i] |= above[parent[i]]
    return np.concatenate([shape, tags, here, above], axis=1)


def rule_labels(tree: Tree) -> np.ndarray:
    """The sample's labels: in the main part or around it, and in nothing else that has a meaning."""
    here, n = meanings(tree), len(tree.tag)
    main, other = here[:, 0].copy(), here[:, 1:].any(axis=1)
    around = here[:, 0] & ~other
    for i in range(1, n):
        p = tree.parent[i]
        main[i] |= main[p]
        other[i] |= other[p]
    good = main & ~other
    for i in range(n - 1, 0, -1):
        around[tree.parent[i]] |= around[i] & ~other[i]
    return good | (around & ~other)


def grafted(html: str, texts: list[str], rng: random.Random) -> str:
    """The page with boilerplate of other kinds and content of other shapes put in, and perhaps another name for its main part."""
    def some() -> str:
        words = rng.choice(texts).split()
        return " ".join(words[:rng.choice([1, 2, 4, 10, 40, 200])])

    def list_of(link: bool) -> str:
        return "<ul>" + "".join(f"<li><a href='#'>{some()}</a></li>" if link else f"<li>{some()}</li>" for _ in range(rng.randint(1, 5))) + "</ul>"

    def boilerplate() -> str:
        kind = rng.choice([k for k in MEANINGS if k != "main"])
        tags, words = MEANINGS[kind]
        inner = "".join(rng.choice([f"<p>{some()}</p>", list_of(True), list_of(False), some(), f"<div>{some()}</div>", f"<h3>{some()}</h3>"])
                        for _ in range(rng.randint(1, 3)))
        tag = rng.choice(sorted(tags)) if tags and rng.random() < 0.5 else rng.choice(["div", "div", "section", "p", "ul"])
        name = "" if tag in tags and rng.random() < 0.5 else f' {rng.choice(["class", "id"])}="{rng.choice(words.split())}"'
        return f"<{tag}{name}>{inner}</{tag}>"

    def content() -> str:
        cells = "".join(f"<tr><td>{some()}</td><td>{some()}</td></tr>" for _ in range(rng.randint(1, 4)))
        return rng.choice([list_of(rng.random() < 0.2), f"<table>{cells}</table>", f"<blockquote>{some()}</blockquote>", f"<h2>{some()}</h2><p>{some()}</p>",
                           f"<pre>{some()}</pre>", f"<div><p>{some()}</p></div>", f"<p>{some()} <a href='#'>{some()}</a> {some()}</p>",
                           f"<section><h3>{some()}</h3><p>{some()}</p></section>", f"<figure><figcaption>{some()}</figcaption></figure>"])

    for border in ("<article>", "</article>", "<footer>", "</nav>"):
        if rng.random() < 0.5:
            html = html.replace(border, border + boilerplate() if border != "</article>" else boilerplate() + border, 1)
    parts = html.split("</p>")
    html = parts[0] + "".join("</p>" + (content() if rng.random() < 0.15 else boilerplate() if rng.random() < 0.1 else "") + x for x in parts[1:])
    if rng.random() < 0.6:
        name = rng.choice(["main", 'div class="post-content"', 'div id="content"', 'section class="story"', 'div class="entry"', 'div class="article-body"'])
        html = html.replace("<article>", f"<{name}>").replace("</article>", f"</{name.split()[0]}>")
    return html


def fit(pages: DataFrame, max_pages: int = MAX_PAGES) -> Trees | None:
    """The trees from a bounded sample of the pages' blocks; none if no page has a block.

    The sample takes pages of any length by their hash. They are parsed in tasks, which send features of at most MAX_BLOCKS blocks of each
    page and copy; no page reaches the driver.
    """
    key = F.xxhash64("page_id", "html")
    usable = pages.where(F.col("html").isNotNull())
    keys = sampling.by_hash(usable.select(key.alias("key")), max_pages)["key"].to_pylist()
    if not keys:
        return None
    chosen = usable.select(key.alias("key"), "html").where(F.col("key").isin(keys)).dropDuplicates(["key"])

    def some_texts(batches):
        for part in batches:
            for k, html in zip(part.column("key").to_pylist(), part.column("html").to_pylist(), strict=True):
                texts = [t[:TEXT_CHARS] for _, t in Tree(html).blocks()]
                texts = random.Random(k).sample(texts, min(PAGE_TEXTS, len(texts)))
                yield pa.RecordBatch.from_arrays([pa.array([k] * len(texts), pa.int64()), pa.array(texts, pa.string())], ["key", "t"])

    rows = sorted(tuple(r) for r in chosen.mapInArrow(some_texts, "key long, t string").collect())  # max_pages x PAGE_TEXTS at most
    texts = [t.replace("<", "").replace("&", "") for _, t in rows]
    texts = [t for t in random.Random(5).sample(texts, min(500, len(texts))) if t.split()] or ["text"]

    def sampled(batches):
        for part in batches:
            for k, html in zip(part.column("key").to_pylist(), part.column("html").to_pylist(), strict=True):
                rng, found = random.Random(k), []
                for copy in range(1 + GRAFTS):
                    tree = Tree(grafted(html, texts, rng) if copy else html)
                    x, y = features(tree), rule_labels(tree)
                    at = np.sort(np.random.Generator(np.random.PCG64(k % (1 << 62))).permutation(len(y))[:MAX_BLOCKS])
                    found.append(np.column_stack([x[at], y[at]]))
                both = np.concatenate(found)
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([both.astype("<f8").tobytes()], pa.binary()),
                                                  pa.array([both.shape[1]], pa.int64())], ["key", "rows", "width"])

    parts = sorted(tuple(r) for r in chosen.mapInArrow(sampled, "key long, rows binary, width long").collect())
    both = np.concatenate([np.frombuffer(data, "<f8").reshape(-1, width) for _, data, width in parts])
    plain, label = both[:, :-1], both[:, -1]
    masked = plain.copy()
    masked[:, N_SHAPE + len(TAG_GROUPS):] = 0
    weight = np.concatenate([np.ones(len(label)), np.full(len(label), 0.05)])
    return Trees(depth=5, rounds=60).fit(np.concatenate([plain, masked]), np.concatenate([label, label]), weight)


def kept_blocks(tree: Tree, odds: np.ndarray) -> np.ndarray:
    """The most likely choice in which a kept block's ancestors are kept."""
    n = len(odds)
    keep, drop = -np.logaddexp(0, -odds), -np.logaddexp(0, odds)
    for i in range(n - 1, 0, -1):
        p = tree.parent[i]
        keep[p] += max(keep[i], drop[i])
        drop[p] += drop[i]
    out = keep > drop
    for i in range(1, n):
        out[i] &= out[tree.parent[i]]
    return out


def main_texts(pages: list[str], trees: Trees | None) -> list[str]:
    """The main text of each page; all blocks of the pages pass the trees together."""
    if trees is None or not pages:
        return [""] * len(pages)
    parsed = [Tree(html) for html in pages]
    odds = trees.log_odds(np.concatenate([features(tree) for tree in parsed]))
    out, at = [], 0
    for tree in parsed:
        kept = kept_blocks(tree, odds[at:at + len(tree.tag)])
        at += len(tree.tag)
        out.append("\n\n".join(t for b, t in tree.blocks() if kept[b]))
    return out


def main_text(html: str, trees: Trees | None) -> str:
    return main_texts([html], trees)[0]


def extract(pages: DataFrame, trees: Trees | None, keep_html: bool = False) -> DataFrame:
    """`pages` with the ADDED columns."""
    spark = pages.sparkSession
    arrowtext.bounded_batches(spark)
    shared = spark.sparkContext.broadcast(trees)
    kept = [f for f in pages.schema.fields if f.name not in ADDED and (keep_html or f.name != "html")]

    def run(batches):
        for part in arrowtext.chunks(batches, "html", limit=1 << 20):
            found = main_texts(arrowtext.texts(part.column("html")), shared.value)
            yield pa.RecordBatch.from_arrays([*[part.column(f.name) for f in kept], pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())],
                                             [*[f.name for f in kept], *ADDED])

    return pages.mapInArrow(run, T.StructType([*kept, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]))
