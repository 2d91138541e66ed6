"""Office documents to markdown rows: shredded parts in, Spark expressions for the text.

docx, pptx and xlsx are zip files of markup, read with the standard library; a PDF or legacy converter is a
callable the caller supplies.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaymill.functions.genes import strip
from assaymill.operators.documents import below, full, markdown_table, pick
from assaymill.sources.xml import shred

PART = re.compile(r"^(word/document|ppt/slides/slide\d+|xl/sharedStrings|xl/workbook|xl/worksheets/sheet\d+)\.xml$")


def parts(files: DataFrame) -> DataFrame:
    """(path, part, xml): the text-bearing parts of `(path, content)` office files; a bad file gives none."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, blob in zip(b["path"], b["content"]):
                try:
                    with zipfile.ZipFile(io.BytesIO(blob)) as z:
                        got = [(n, z.read(n).decode("utf-8", "replace")) for n in z.namelist() if PART.match(n)]
                except zipfile.BadZipFile:
                    continue
                if got:
                    yield pd.DataFrame({"path": path, "part": [g[0] for g in got], "xml": [g[1] for g in got]})
    return files.select("path", "content").mapInPandas(run, "path string, part string, xml string")


def _rows(table, nodes, plain, row: str, cell: str):
    inside = below(table, nodes)
    return F.transform(pick(inside, row), lambda r: F.transform(
        pick(below(r, nodes), cell), lambda c: F.replace(full(c, plain), F.lit("|"), F.lit("\\|"))))


def word_markdown(office: DataFrame) -> DataFrame:
    """(path, text): paragraphs with heading marks, then tables."""
    n, plain = F.col("nodes"), F.col("plain")
    d = shred(office.where(F.col("part") == "word/document.xml")).where("nodes IS NOT NULL")
    tables = pick(n, "tbl")
    loose = F.filter(pick(n, "p"), lambda p: ~F.exists(tables, lambda t: (t["pos"] < p["pos"]) & (p["pos"] <= t["stop"])))

    def para(p):
        style = F.get(F.filter(below(p, n), lambda s: s["tag"] == "pStyle"), F.lit(0))["attrs"]["val"]
        level = F.coalesce(F.nullif(F.regexp_extract(style, r"(\d+)", 1), F.lit("")).try_cast("int"), F.lit(1))
        return F.when(style.rlike("(?i)heading"), F.concat(
            F.repeat(F.lit("#"), level + 1), F.lit(" "), full(p, plain))).otherwise(full(p, plain))

    texts = F.filter(F.transform(F.filter(loose, lambda p: full(p, plain) != ""), para), lambda t: t.isNotNull())
    grids = F.transform(tables, lambda t: markdown_table(_rows(t, n, plain, "tr", "tc")))
    return d.select("path", F.array_join(F.concat(texts, F.filter(grids, lambda g: g != "")), "\n\n").alias("text"))


def slides_markdown(office: DataFrame) -> DataFrame:
    """(path, text): `### Slide n` with the shape texts and tables of each slide."""
    n, plain = F.col("nodes"), F.col("plain")
    d = shred(office.where(F.col("part").startswith("ppt/"))).where("nodes IS NOT NULL")
    no = F.regexp_extract("part", r"slide(\d+)", 1).cast("int")
    shapes = F.transform(pick(n, "txBody"), lambda b: F.array_join(
        F.transform(pick(below(b, n), "p"), lambda p: full(p, plain)), "\n"))
    grids = F.transform(pick(n, "tbl"), lambda t: markdown_table(_rows(t, n, plain, "tr", "tc")))
    body = F.array_join(F.filter(F.concat(F.transform(shapes, strip), grids), lambda t: t != ""), "\n\n")
    s = d.select("path", no.alias("no"), body.alias("body")).where("body <> ''")
    one = F.concat(F.lit("### Slide "), F.col("no").cast("string"), F.lit("\n\n"), F.col("body"))
    # A presentation's slides came as one file, so gathering them again is bounded by it.
    return s.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("no", one.alias("t")))).alias("x")).select(
        "path", F.array_join(F.transform("x", lambda v: v["t"]), "\n\n").alias("text"))


def workbook_rows(office: DataFrame) -> DataFrame:
    """(path, sheet, rows): sheets as arrays of rows of cell texts, shared strings looked up; gaps stay empty."""
    n, plain = F.col("nodes"), F.col("plain")
    d = shred(office.where(F.col("part").startswith("xl/"))).where("nodes IS NOT NULL")
    shared = d.where(F.col("part") == "xl/sharedStrings.xml").select(
        "path", F.transform(pick(n, "si"), lambda s: full(s, plain)).alias("_shared"))
    names = d.where(F.col("part") == "xl/workbook.xml").select(
        "path", F.transform(pick(n, "sheet"), lambda s: s["attrs"]["name"]).alias("_names"))
    sheets = d.where(F.col("part").startswith("xl/worksheets/")).withColumn(
        "_no", F.regexp_extract("part", r"sheet(\d+)", 1).cast("int"))
    j = sheets.join(shared, "path", "left").join(names, "path", "left")

    def column(ref):
        letters = F.regexp_extract(ref, r"^([A-Z]+)", 1)
        codes = F.transform(F.split(letters, ""), lambda ch: F.when(ch != "", F.ascii(ch) - 64).otherwise(F.lit(0)))
        return F.aggregate(codes, F.lit(0), lambda acc, c: F.when(c > 0, acc * 26 + c).otherwise(acc))

    def cell(c):
        raw = full(c, plain)
        looked = F.get("_shared", raw.try_cast("int"))
        return F.struct(column(c["attrs"]["r"]).alias("k"), F.when(c["attrs"]["t"] == "s", looked).otherwise(raw).alias("v"))

    def line(r):
        found = F.transform(pick(below(r, n), "c"), cell)
        width = F.coalesce(F.array_max(F.transform(found, lambda x: x["k"])), F.lit(0))
        return F.when(width > 0, F.transform(F.sequence(F.lit(1), F.greatest(width, F.lit(1))), lambda k: F.coalesce(
            F.get(F.filter(found, lambda x: x["k"] == k), F.lit(0))["v"], F.lit("")))).otherwise(
                F.array().cast("array<string>"))

    rows = F.filter(F.transform(pick(n, "row"), line), lambda r: F.size(r) > 0)
    return j.select("path", F.coalesce(F.get("_names", F.col("_no") - 1), F.concat(F.lit("Sheet"), F.col("_no").cast("string")))
                    .alias("sheet"), F.col("_no").alias("sheet_no"), rows.alias("rows"))


def workbook_markdown(office: DataFrame, limit: int | None = None) -> DataFrame:
    """(path, text): each sheet as a table under its name, of its first `limit` rows where that is given."""
    w = workbook_rows(office).where(F.size("rows") > 1)
    shown = F.col("rows") if limit is None else F.slice("rows", 1, limit + 1)
    safe = F.transform(shown, lambda r: F.transform(
        r, lambda c: F.replace(F.replace(c, F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" "))))
    one = F.concat(F.lit("### Sheet: "), F.col("sheet"), F.lit("\n\n"), markdown_table(safe))
    return w.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("sheet_no", one.alias("t")))).alias("x")).select(
        "path", F.array_join(F.transform("x", lambda v: v["t"]), "\n\n").alias("text"))


def utf16_runs(files: DataFrame, shortest: int = 20) -> DataFrame:
    """(path, text): distinct printable UTF-16 runs longer than 20 characters, as found in legacy slide files."""
    text = F.decode("content", "UTF-16LE")
    runs = F.transform(F.regexp_extract_all(text, F.lit(r"([^\x00-\x08\x0e-\x1f]{20,})"), F.lit(1)), strip)
    kept = F.array_distinct(F.filter(runs, lambda r: F.length(r) > shortest))
    return files.select("path", F.array_join(kept, "\n\n").alias("text"))


def convert(files: DataFrame, converter: Callable[[bytes], str | None] | None = None, shortest: int = 100) -> DataFrame:
    """(path, text) of PDFs and other formats through a converter; none configured, or under 100 characters, gives none."""
    if converter is None:
        return files.sparkSession.createDataFrame([], "path string, text string")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"path": b["path"], "text": [converter(c) for c in b["content"]]})

    return files.select("path", "content").mapInPandas(run, "path string, text string").where(
        F.length(strip(F.coalesce("text", F.lit("")))) > shortest)
