"""Articles: from shredded markup to metadata, markdown sections, references and budgeted text.

`sources.xml.shred` turns one article into an array of nodes in document order; everything here is an
expression over that array. A node's descendants are the nodes next to it, so they are a slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaymill.functions import text as T
from assaymill.functions.genes import strip
from assaymill.session import settle

def below(n: Column, nodes: Column) -> Column:
    """Descendants of a node."""
    return F.slice(nodes, n["pos"] + 2, n["stop"] - n["pos"])


def full(n: Column, plain: Column) -> Column:
    """All text inside a node, stripped."""
    return strip(F.substring(plain, n["start"] + 1, n["length"]))


def pick(nodes: Column, *tags: str, parent: Column | None = None) -> Column:
    """Nodes with one of the tags, optionally only the children of a node."""
    def test(n):
        ok = n["tag"].isin(*tags)
        return ok if parent is None else ok & (n["parent"] == parent)
    return F.filter(nodes, test)


def first(nodes: Column) -> Column:
    return F.get(nodes, F.lit(0))


def _id_text(ids: Column, kind: str) -> Column:
    return F.nullif(strip(first(F.filter(ids, lambda n: n["attrs"]["pub-id-type"] == kind))["text"]), F.lit(""))


def paragraph(p: Column, nodes: Column, plain: Column) -> Column:
    """Text of a paragraph with bold, italic, superscript and subscript marks on its direct children."""
    children = F.filter(below(p, nodes), lambda c: c["parent"] == p["pos"])

    def mark(c):
        inner = full(c, plain)
        marked = (F.when(c["tag"].isin("bold", "b"), F.concat(F.lit("**"), inner, F.lit("**")))
                  .when(c["tag"].isin("italic", "i"), F.concat(F.lit("*"), inner, F.lit("*")))
                  .when(c["tag"] == "sup", F.concat(F.lit("^"), inner))
                  .when(c["tag"] == "sub", F.concat(F.lit("_"), inner)).otherwise(inner))
        return F.concat(marked, c["tail"])

    return strip(F.concat(p["text"], F.array_join(F.transform(children, mark), "")))


def markdown_table(rows: Column) -> Column:
    """Markdown of an array of rows of cells: ragged rows are padded, the first row is the header."""
    width = F.array_max(F.transform(rows, F.size))

    def padded(r):
        return F.concat(r, F.array_repeat(F.lit(""), width - F.size(r)))

    def line(r):
        return T.markdown_row(r)

    head = F.get(rows, F.lit(0))
    lines = F.concat(
        F.array(line(padded(head)), line(F.array_repeat(F.lit("---"), width))),
        F.transform(F.slice(rows, F.lit(2), F.size(rows)), lambda r: line(padded(r))))
    return F.when(F.size(rows) > 0, F.array_join(lines, "\n")).otherwise(F.lit(""))


def _table(t: Column, nodes: Column, plain: Column) -> Column:
    inside = below(t, nodes)
    rows = F.transform(
        F.filter(inside, lambda n: n["tag"] == "tr"),
        lambda tr: F.transform(
            F.filter(below(tr, nodes), lambda c: (c["parent"] == tr["pos"]) & c["tag"].isin("th", "td")),
            lambda c: strip(F.regexp_replace(
                F.replace(full(c, plain), F.lit("|"), F.lit("\\|")), r"\s+", " "))))
    return markdown_table(F.filter(rows, lambda r: F.size(r) > 0))


def _table_wrap(w: Column, nodes: Column, plain: Column) -> Column:
    inside = below(w, nodes)
    own = F.filter(inside, lambda n: n["parent"] == w["pos"])
    label = F.coalesce(full(first(pick(own, "label")), plain), F.lit(""))
    caption = first(pick(own, "caption"))
    title = first(F.filter(inside, lambda n: (n["tag"] == "title") & (n["parent"] == caption["pos"])))
    cap = F.coalesce(F.nullif(full(title, plain), F.lit("")), full(caption, plain), F.lit(""))
    head = F.when((label != "") | (cap != ""), F.concat(F.lit("\n**"), label, F.lit("** "), cap, F.lit("\n")))
    table = first(F.filter(inside, lambda n: n["tag"] == "table"))
    body = F.nullif(F.coalesce(_table(table, nodes, plain), F.lit("")), F.lit(""))
    return F.concat_ws("\n", head, body)


def _figure(f: Column, nodes: Column, plain: Column) -> Column:
    inside = below(f, nodes)
    caption = full(first(pick(inside, "caption")), plain)
    label = F.coalesce(full(first(pick(inside, "label", parent=f["pos"])), plain), F.lit(""))
    return F.when(F.coalesce(caption, F.lit("")) != "",
                  F.concat(F.lit("\n**"), label, F.lit("** "), caption, F.lit("\n"))).otherwise(F.lit(""))


def _list(li: Column, nodes: Column, plain: Column) -> Column:
    items = F.transform(pick(below(li, nodes), "list-item", parent=li["pos"]), lambda i: full(i, plain))
    return F.array_join(F.transform(F.filter(items, lambda t: t != ""), lambda t: F.concat(F.lit("- "), t)), "\n")


# Elements rendered as one block; nothing inside them is visited on its own.
BLOCKS = ["title", "p", "table-wrap", "fig", "list", "supplementary-material"]


def section_markdown(sec: Column, nodes: Column, plain: Column) -> Column:
    """Markdown of a section: its blocks in document order, with the raw text between them."""
    inside = F.filter(below(sec, nodes), lambda n: n["shield"] <= sec["pos"])

    def once(value, use):
        """`use` of a value that is computed once."""
        return F.get(F.transform(F.array(value), use), F.lit(0))

    def opened(n):
        depth = F.least(n["secs"] - sec["secs"] + 1, F.lit(6))
        words = full(n, plain)
        block = (
            F.when(n["tag"] == "title", F.when(words != "", F.concat(
                F.lit("\n"), F.repeat(F.lit("#"), depth), F.lit(" "), words, F.lit("\n"))).otherwise(F.lit("")))
            .when(n["tag"] == "p", once(paragraph(n, nodes, plain), lambda t: F.when(
                t != "", F.concat(F.lit("\n"), t, F.lit("\n"))).otherwise(F.lit(""))))
            .when(n["tag"] == "table-wrap", _table_wrap(n, nodes, plain))
            .when(n["tag"] == "fig", _figure(n, nodes, plain))
            .when(n["tag"] == "list", _list(n, nodes, plain))
            .when(n["tag"] == "supplementary-material", F.when(F.length(words) > 50, F.concat(
                F.lit("\n**Supplementary Material:**\n"), words, F.lit("\n"))).otherwise(F.lit("")))
            .otherwise(n["text"]))
        return F.struct(n["pos"].alias("a"), F.lit(0).alias("b"), F.lit(0).alias("c"), block.alias("s"))

    def closed(n):
        return F.struct(n["stop"].alias("a"), F.lit(1).alias("b"), (-n["depth"]).alias("c"), n["tail"].alias("s"))

    pieces = F.array_sort(F.concat(F.transform(inside, opened), F.transform(inside, closed)))
    return F.concat(sec["text"], F.array_join(F.transform(pieces, lambda x: x["s"]), ""))


def abstract_markdown(ab: Column, nodes: Column, plain: Column, marked: bool = True) -> Column:
    """Abstract text: titled sections or paragraphs, else whatever it holds."""
    inside = below(ab, nodes)
    secs = pick(inside, "sec", parent=ab["pos"])

    def para(p):
        return paragraph(p, nodes, plain) if marked else full(p, plain)

    def of_section(s):
        t = full(first(pick(inside, "title", parent=s["pos"])), plain)
        head = F.when(F.coalesce(t, F.lit("")) != "", F.concat(F.lit("**"), t, F.lit("**")) if marked else t)
        return F.concat(F.array(head), F.transform(pick(inside, "p", parent=s["pos"]), para))

    parts = F.when(F.size(secs) > 0, F.flatten(F.transform(secs, of_section))).otherwise(
        F.transform(pick(inside, "p", parent=ab["pos"]), para))
    text = F.array_join(F.filter(parts, lambda x: x.isNotNull() & (x != "")), "\n")
    return F.when(text != "", text).otherwise(full(ab, plain))


def metadata(shredded: DataFrame) -> DataFrame:
    """Ids, title, abstract and article type; articles without metadata or title are left out."""
    n, plain = F.col("nodes"), F.col("plain")
    meta = first(pick(n, "article-meta"))
    d = shredded.where("nodes IS NOT NULL").withColumn("_meta", meta).where("_meta IS NOT NULL")
    inside = below(F.col("_meta"), n)
    ids = pick(inside, "article-id", parent=F.col("_meta.pos"))
    title = full(first(pick(inside, "article-title")), plain)
    abstracts = F.transform(pick(inside, "abstract", parent=F.col("_meta.pos")),
                            lambda a: abstract_markdown(a, n, plain, marked=False))
    return d.select(
        "path",
        F.coalesce(_id_text(ids, "pmcid"), F.regexp_replace(_base(F.col("path")), r"\.xml$", "")).alias("pmc_id"),
        _id_text(ids, "pmid").alias("pmid"), _id_text(ids, "doi").alias("doi"), title.alias("title"),
        F.coalesce(first(F.filter(abstracts, lambda a: a != "")), F.lit("")).alias("abstract"),
        first(pick(n, "article"))["attrs"]["article-type"].alias("article_type"),
    ).where(F.coalesce("title", F.lit("")) != "")


def _base(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def sections(shredded: DataFrame) -> DataFrame:
    """Articles with ordered `sections` (title, text), merged by title, plus title, abstract and counters."""
    n, plain = F.col("nodes"), F.col("plain")
    d = shredded.where("nodes IS NOT NULL")
    d = d.withColumn("_meta", first(pick(n, "article-meta"))).where("_meta IS NOT NULL")
    article = first(pick(n, "article"))
    d = d.withColumn("_body", first(pick(n, "body", parent=article["pos"])))
    d = d.withColumn("_back", first(pick(n, "back", parent=article["pos"])))
    in_body = below(F.col("_body"), n)
    in_back = below(F.col("_back"), n)

    def titled(s, default):
        t = first(F.filter(below(s, n), lambda c: (c["tag"] == "title") & (c["parent"] == s["pos"])))
        return F.coalesce(full(t, plain), F.lit(default))

    pair = "array<struct<title:string,text:string>>"
    none = F.array().cast(pair)

    def rows(secs, default):
        return F.coalesce(F.transform(secs, lambda s: F.struct(
            titled(s, default).alias("title"), section_markdown(s, n, plain).alias("text"))), none)

    d = d.withColumn("_secs", rows(pick(in_body, "sec", parent=F.col("_body.pos")), "Untitled"))
    loose = F.transform(pick(in_body, "p", parent=F.col("_body.pos")), lambda p: paragraph(p, n, plain))
    loose = F.filter(loose, lambda t: t != "")
    inline = F.filter(F.transform(pick(n, "supplementary-material"), lambda s: full(s, plain)),
                      lambda t: F.length(t) > 100)
    d = d.withColumn("_loose", loose).withColumn("_inline", inline)
    d = d.withColumn("_late", F.filter(rows(pick(in_back, "sec"), "Back Matter"), lambda s: strip(s["text"]) != ""))

    # Body sections of one title are joined; loose paragraphs and inline supplements continue theirs.
    def joined(title):
        own = F.transform(F.filter("_secs", lambda s: s["title"] == title), lambda s: s["text"])
        body = F.array_join(own, "\n")
        body = F.when(title == "Body", F.concat(body, F.array_join(
            F.transform("_loose", lambda t: F.concat(F.lit("\n"), t)), ""))).otherwise(body)
        body = F.when(title == "Supplementary Materials", F.concat(body, F.array_join(
            F.transform("_inline", lambda t: F.concat(F.lit("\n"), t, F.lit("\n"))), ""))).otherwise(body)
        # Back matter replaces a section of the same title, the last one winning.
        over = F.try_element_at(F.filter("_late", lambda s: s["title"] == title), F.lit(-1))["text"]
        return F.struct(title.alias("title"), F.coalesce(over, body).alias("text"))

    none_s = F.array().cast("array<string>")
    titles = F.array_distinct(F.concat(
        F.transform("_secs", lambda s: s["title"]),
        F.when(F.size("_loose") > 0, F.array(F.lit("Body"))).otherwise(none_s),
        F.when(F.size("_inline") > 0, F.array(F.lit("Supplementary Materials"))).otherwise(none_s),
        F.coalesce(F.transform("_late", lambda s: s["title"]), none_s)))
    meta_in = below(F.col("_meta"), n)
    ids = pick(meta_in, "article-id", parent=F.col("_meta.pos"))
    abstracts = F.transform(pick(meta_in, "abstract", parent=F.col("_meta.pos")),
                            lambda a: abstract_markdown(a, n, plain))
    tables = pick(in_body, "table-wrap")
    in_sec = F.filter(tables, lambda t: F.exists(
        pick(in_body, "sec", parent=F.col("_body.pos")), lambda s: (s["pos"] < t["pos"]) & (t["pos"] <= s["stop"])))
    return settle(d.select(
        "path",
        F.coalesce(_id_text(ids, "pmcid"), F.regexp_replace(_base(F.col("path")), r"\.xml$", "")).alias("pmc_id"),
        F.coalesce(full(first(pick(meta_in, "article-title")), plain), F.lit("")).alias("title"),
        F.coalesce(first(F.filter(abstracts, lambda a: a != "")), F.lit("")).alias("abstract"),
        F.transform(titles, joined).alias("sections"),
        F.exists("_secs", lambda s: T.section_class(s["title"]) == "methods").alias("has_methods"),
        (F.size("_inline") > 0).alias("has_supplement_inline"),
        F.coalesce(F.size(in_sec), F.lit(0)).alias("tables_found")))


def with_budgeted_text(df: DataFrame, budget: int | None = None, name: str = "full_text") -> DataFrame:
    """`df` (title, abstract, sections) with the paper's text, whole unless a budget is given.

    With one, sections come by priority while they fit; must-have ones are cut, others skipped. The fold only tracks how
    much of each block to take; the text is put together once at the end.
    """
    marker = "\n\n[... truncated ...]\n"
    header = F.concat(F.lit("# "), F.col("title"), F.lit("\n\n## Abstract\n"), F.col("abstract"), F.lit("\n\n"))
    d = df.withColumn("_head", header).withColumn("_blocks", F.array_sort(F.transform("sections", lambda s, i: F.struct(
        T.section_priority(s["title"]).alias("priority"), i.alias("i"),
        F.concat(F.lit("## "), s["title"], F.lit("\n"), s["text"], F.lit("\n\n")).alias("block")))))
    if budget is None:
        whole = F.array_join(F.transform("_blocks", lambda s: s["block"]), "")
        return d.withColumn(name, F.concat("_head", whole)).drop("_head", "_blocks")
    d = d.withColumn("_sizes", F.transform("_blocks", lambda s: F.struct(
        (s["priority"] <= 1).alias("must"), F.length(s["block"]).alias("size"))))

    def step(acc, s):
        room = F.lit(budget) - acc["total"]
        fits = s["size"] <= room
        cut = ~fits & s["must"] & (room > 200)
        take = F.when(fits, s["size"]).when(cut, room - 50).otherwise(F.lit(-1))
        used = F.when(fits, s["size"]).when(cut, room - 50 + len(marker)).otherwise(F.lit(0))
        return F.struct((acc["total"] + used).alias("total"), F.concat(acc["takes"], F.array(take)).alias("takes"))

    start = F.struct(F.length("_head").alias("total"), F.array().cast("array<int>").alias("takes"))
    d = d.withColumn("_takes", F.aggregate("_sizes", start, step)["takes"])
    parts = F.transform("_blocks", lambda s, i: F.when(
        F.get("_takes", i) >= F.get("_sizes", i)["size"], s["block"]).when(F.get("_takes", i) >= 0, F.concat(
            F.substring(s["block"], F.lit(1), F.get("_takes", i)), F.lit(marker))).otherwise(F.lit("")))
    return d.withColumn(name, F.concat("_head", F.array_join(parts, ""))).drop("_head", "_blocks", "_sizes", "_takes")


def papers_text(shredded: DataFrame, budget: int | None = None) -> DataFrame:
    """Parsed papers with their full text, cut only to a budget that is asked for."""
    return settle(with_budgeted_text(sections(shredded), budget)).withColumn("char_count", F.length("full_text"))


def references(shredded: DataFrame) -> DataFrame:
    """Reference list entries with ids, title, label, first author and year; kept if they can be matched."""
    n, plain = F.col("nodes"), F.col("plain")

    def entry(r):
        inside = below(r, n)

        def pub_id(*kinds):
            hits = F.filter(inside, lambda x: (x["tag"] == "pub-id") & x["attrs"]["pub-id-type"].isin(*kinds))
            return strip(F.try_element_at(hits, F.lit(-1))["text"])

        def tag1(*tags):
            return F.coalesce(*[first(pick(inside, t)) for t in tags])

        cite = tag1("element-citation", "mixed-citation", "nlm-citation", "citation")
        scope = F.coalesce(F.when(cite.isNotNull(), below(cite, n)), inside)

        def parent_tag(x):
            return F.get(n, x["parent"])["tag"]

        surnames = pick(scope, "surname")
        in_name = F.filter(surnames, lambda s: parent_tag(s) == "name")
        in_group = F.filter(in_name, lambda s: F.get(n, F.get(n, s["parent"])["parent"])["tag"] == "person-group")
        surname = F.coalesce(first(in_group), first(in_name), first(surnames))["text"]
        label = first(pick(inside, "label", parent=r["pos"]))["text"]
        return F.struct(
            pub_id("doi").alias("doi"), pub_id("pmid").alias("pmid"), pub_id("pmcid", "pmc").alias("pmc_id"),
            full(tag1("article-title", "source"), plain).alias("title"), strip(surname).alias("first_author_surname"),
            strip(first(pick(scope, "year"))["text"]).alias("year"),
            F.regexp_replace(strip(label), r"^[.\[\]()]+|[.\[\]()]+$", "").alias("label"))

    entries = F.transform(pick(n, "ref"), entry)
    out = (shredded.where("nodes IS NOT NULL").select("path", F.posexplode(entries).alias("ref_no", "_entry"))
           .select("path", "ref_no", "_entry.*"))

    def given(c):
        return F.coalesce(F.col(c), F.lit("")) != ""

    return out.where(given("doi") | given("pmid") | given("pmc_id")
                     | (given("first_author_surname") & given("year")))


# File kinds that are never supplements worth reading.
SKIPPED_FILES = [".tif", ".tiff", ".png", ".jpg", ".jpeg", ".gif", ".bmp", ".svg", ".eps", ".nxml"]


def supplement_manifest(shredded: DataFrame, skip: list[str] | None = None) -> DataFrame:
    """Supplementary files an article names, with label and caption; images are left out."""
    n, plain = F.col("nodes"), F.col("plain")

    def entry(s):
        inside = below(s, n)
        media = first(pick(inside, "media", parent=s["pos"]))
        href = F.coalesce(F.nullif(s["attrs"]["href"], F.lit("")), F.nullif(media["attrs"]["href"], F.lit("")))
        return F.struct(
            F.substring_index(href, "/", -1).alias("filename"),
            F.coalesce(strip(first(pick(inside, "label", parent=s["pos"]))["text"]), F.lit("")).alias("label"),
            F.coalesce(full(first(pick(inside, "caption")), plain), F.lit("")).alias("caption"))

    s = (shredded.where("nodes IS NOT NULL")
         .select("path", F.explode(F.transform(pick(n, "supplementary-material"), entry)).alias("s"))
         .select("path", "s.*").where("filename IS NOT NULL"))
    ext = F.lower(F.regexp_extract("filename", r"[^.](\.[^.]*)$", 1))
    return (s.select("path", "filename", ext.alias("extension"), "label", "caption")
            .where(~F.col("extension").isin(skip or SKIPPED_FILES)))


def split_article_set(raw: DataFrame, column: str = "raw") -> DataFrame:
    """(pmc_id, xml) of every article in a fetched set; the id falls back from pmcid to pmcaid."""
    bare = F.regexp_replace(F.regexp_replace(column, r"<!DOCTYPE[^>]*>", ""), r"<\?xml[^>]*\?>", "")
    a = raw.select(F.explode(F.regexp_extract_all(bare, F.lit(r"(?s)<article(?:\s[^>]*)?>.*?</article>"), F.lit(0)))
                   .alias("xml"))

    def found(kind):
        return F.nullif(F.regexp_extract(
            "xml", r'<article-id[^>]*pub-id-type="' + kind + r'"[^>]*>([^<]*)</article-id>', 1), F.lit(""))

    pmc = F.coalesce(found("pmcid"), found("pmcaid"))
    return a.select(F.substring_index(F.replace(pmc, F.lit("PMC"), F.lit("")), ".", 1).alias("pmc_id"), "xml").where(
        F.coalesce("pmc_id", F.lit("")) != "")
