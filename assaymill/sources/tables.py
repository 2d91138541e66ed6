"""Delimited tables of unknown layout: which column holds genes, which hold values, what kind of table it is.

A table is its lines `(path, pos, line)`, read by as many tasks as its size asks for (`files.lines`). One aggregation per file learns the
delimiter, the header and what all rows say about the columns (`profiles`); lines that name a panel gene are kept by a narrow pass and
cut into cells then (`panel_rows`). `parse` holds a small table as arrays in one row, for its markdown.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assaymill.functions import genes
from assaymill.functions.numbers import to_double, unquote, unquote_all
from assaymill.functions.text import cell, markdown_row
from assaymill.session import cut, few, settle
from assaymill.sources import files


def lines(content: Column) -> Column:
    return F.filter(F.split(content, r"\r?\n"), lambda l: l != "")


def sniff_delimiter(content: Column) -> Column:
    """Tab if there is one, else the more frequent of semicolon and comma in the whole content."""
    semis, commas = F.regexp_count(content, F.lit(";")), F.regexp_count(content, F.lit(","))
    return (F.when(content.contains("\t"), "\t").when((semis > 0) & (semis > commas), ";")
            .when(commas > 0, ",").otherwise("\t"))


def cells(line: Column, delimiter: Column) -> Column:
    """Cells of a line; a delimiter inside double quotes does not split."""
    quoted = F.concat(delimiter, F.lit(r'(?=(?:[^"]*"[^"]*")*[^"]*$)'))
    plain = F.split(line, F.concat(F.lit(r"\Q"), delimiter, F.lit(r"\E")), F.lit(-1))
    parts = F.when(F.contains(line, F.lit('"')), F.split(line, quoted, F.lit(-1))).otherwise(plain)
    return F.transform(parts, unquote)


def parse(files: DataFrame) -> DataFrame:
    """`files` with `header` and `rows` (arrays of cells) in place of the content."""
    f = files.withColumn("_d", sniff_delimiter(F.col("content"))).withColumn("_lines", lines(F.col("content")))
    f = settle(f).where(F.size("_lines") > 0)
    return settle(f.withColumn("header", cells(F.get("_lines", F.lit(0)), F.col("_d"))).withColumn(
        "rows", F.transform(F.slice("_lines", F.lit(2), F.size("_lines")), lambda l: cells(l, F.col("_d")))
    ).drop("_d", "_lines", "content"))


#: Delimiters a table may have, in order of preference.
DELIMITERS = ["\t", ";", ","]


def _cut_line(line: Column, delimiter: str, limit: int = -1) -> Column:
    """As `cells`, for one of DELIMITERS; with a limit the last cell holds the rest."""
    quoted = F.split(line, delimiter + r'(?=(?:[^"]*"[^"]*")*[^"]*$)', limit)
    parts = F.when(F.contains(line, F.lit('"')), quoted).otherwise(F.split(line, delimiter, limit))
    return unquote_all(F.when(F.contains(line, F.lit(delimiter)), parts).otherwise(F.array(line)))


def _cut_at(line: Column, delimiter: Column) -> Column:
    """As `cells`, for a column that holds DELIMITERS: each is a pattern of its own, none is built by row."""
    return F.coalesce(*[F.when(delimiter == d, _cut_line(line, d)) for d in DELIMITERS])


def _signs(parts: Column) -> Column:
    """What a row says about its first two columns by its cells, as 0 or 1 each."""
    first, second = F.trim(F.get(parts, F.lit(0))), F.get(parts, F.lit(1))
    tests = {"odd": (second != "") & to_double(second).isNull(), "filled": first != "",
             "symbol": first.rlike(r"^[A-Z][A-Z0-9]{1,15}$"), "ensembl": first.startswith("ENSG")}
    return F.struct(*[F.coalesce(t, F.lit(False)).cast("bigint").alias(n) for n, t in tests.items()])


SIGNS = ["odd", "filled", "symbol", "ensembl"]


def profiles(lines: DataFrame) -> DataFrame:
    """One row per file: (path, delimiter, header, header_line, n_rows, odd, filled, symbol, ensembl), counts over all rows below the header."""
    line, tab = F.col("line"), F.contains("line", F.lit("\t"))

    def count(sign):
        return F.length(line) - F.length(F.replace(line, F.lit(sign), F.lit("")))

    # One tab makes a file tab-separated, so a line with tabs need not be cut otherwise.
    parts = [_cut_line(line, "\t", 3).alias("_p0"), *[F.when(~tab, _cut_line(line, d, 3)).alias(f"_p{i}") for i, d in enumerate(DELIMITERS) if i]]
    seen = settle(lines.where(line != "").select("path", "pos", "line", tab.alias("_tab"), count(";").alias("_semis"), count(",").alias("_commas"), *parts))
    seen = settle(seen.select("path", "pos", "line", "_tab", "_semis", "_commas", *[_signs(F.col(f"_p{i}")).alias(f"_s{i}") for i in range(3)]))
    sums = [F.sum(f"_s{i}.{n}").alias(f"_{n}{i}") for i in range(3) for n in SIGNS]
    f = seen.groupBy("path").agg(F.max("_tab").alias("_tab"), F.sum("_semis").alias("_semis"), F.sum("_commas").alias("_commas"),
                                 F.min_by(F.struct("line", *[f"_s{i}" for i in range(3)]), "pos").alias("_h"), F.count("*").alias("_n"), *sums)
    which = F.when(F.col("_tab"), 0).when((F.col("_semis") > 0) & (F.col("_semis") > F.col("_commas")), 1).when(F.col("_commas") > 0, 2).otherwise(0)
    f = f.withColumn("_d", which)

    def chosen(name):
        return F.coalesce(*[F.when(F.col("_d") == i, F.col(f"_{name}{i}") - F.col(f"_h._s{i}.{name}")) for i in range(3)]).alias(name)

    delimiter = F.element_at(F.lit(DELIMITERS), F.col("_d") + 1)
    return f.select("path", delimiter.alias("delimiter"), _cut_at(F.col("_h.line"), delimiter).alias("header"), F.col("_h.line").alias("header_line"),
                    (F.col("_n") - 1).alias("n_rows"), *[chosen(n) for n in SIGNS])


def panel_rows(lines: DataFrame, found: DataFrame) -> DataFrame:
    """(path, pos, header, cells and the other columns of `found`, the profiles) of rows that name a panel gene in some column.

    A line with a tab can only be cut at tabs. The header is left out: where it names a panel gene it is the first such line of its file.
    """
    line = F.col("line")

    def named(d):
        return F.contains(line, F.lit(d)) & genes.any_target_gene(_cut_line(line, d))

    some = F.when(F.contains(line, F.lit("\t")), named("\t")).otherwise(named(";") | named(",") | F.coalesce(genes.is_target_gene(unquote(line)), F.lit(False)))
    kept = cut(lines.where((line != "") & some).select("path", "pos", "line"))
    first = kept.groupBy("path").agg(F.min("pos").alias("_first"))
    rows = kept.join(first, "path").join(found, "path").where((F.col("pos") != F.col("_first")) | (line != F.col("header_line")))
    return settle(rows.withColumn("cells", _cut_at(line, F.col("delimiter")))).drop("line", "_first", "header_line", "delimiter")


def gene_columns(rows: DataFrame) -> DataFrame:
    """(path, gene_at): the column with the most panel genes over all rows of a file; the first of equal ones."""
    hits = F.filter(F.transform("cells", lambda c, i: F.when(F.coalesce(genes.is_target_gene(c), F.lit(False)), i)), lambda i: i.isNotNull())
    inside = F.filter(hits, lambda i: i < F.size("header"))
    counted = rows.select("path", F.explode(inside).alias("c")).groupBy("path", "c").agg(F.count("*").alias("n"))
    return counted.groupBy("path").agg(F.min(F.struct((-F.col("n")).alias("n"), "c"))["c"].alias("gene_at"))


def _named_at(rows: DataFrame) -> DataFrame:
    """Rows whose cell at `gene_at` is a panel gene, with `gene` and `gene_symbol`."""
    gene = F.get("cells", F.col("gene_at"))
    return rows.where(F.coalesce(genes.is_target_gene(gene), F.lit(False))).withColumn("gene", gene).withColumn("gene_symbol", genes.resolve_alias(gene))


def _last_cells(named: DataFrame) -> DataFrame:
    """(path, gene, gene_symbol, gene_at, c, sample, v): the cells of each gene's last row, beside their header."""
    last = named.groupBy("path", "gene_symbol").agg(F.max_by(F.struct("gene", "header", "gene_at", "cells"), "pos").alias("x"))
    r = last.select("path", "gene_symbol", "x.*")
    width = F.least(F.size("header"), F.size("cells"))
    return r.select("path", "gene", "gene_symbol", "gene_at", F.posexplode(F.arrays_zip(
        F.slice("header", F.lit(1), width).alias("h"), F.slice("cells", F.lit(1), width).alias("v"))).alias("c", "z")).select(
        "path", "gene", "gene_symbol", "gene_at", "c", F.col("z.h").alias("sample"), F.col("z.v").alias("v"))


def count_cells(rows: DataFrame) -> DataFrame:
    """(path, gene, gene_symbol, sample, value) of panel rows; of a gene listed twice the last row counts.

    Cells that are no numbers give NULL.
    """
    c = _last_cells(_named_at(rows.join(gene_columns(rows), "path")))
    return c.where(F.col("c") != F.col("gene_at")).select("path", "gene", "gene_symbol", "sample", to_double(F.col("v")).alias("value"))


# Header words of gene, fold change, adjusted p and mean columns, tried in order.
GENE_HEADERS = ["gene_symbol", "gene_name", "symbol", "gene", "genename", "gene.symbol", "external_gene_name",
                "gene_id", "ensembl_gene_id", "ensembl_id"]
FOLD_HEADERS = ["log2foldchange", "log2fc", "logfc", "log2_fold_change", "foldchange", "fold_change"]
PADJ_HEADERS = ["padj", "p_adj", "fdr", "q_value", "qvalue", "adjusted_pvalue", "adj.p.val"]
MEAN_HEADERS = ["basemean", "base_mean", "aveexpr", "meanexpr", "mean_expression"]
UNIT_HEADERS = ["tpm", "fpkm", "rpkm", "cpm", "counts", "expression", "raw_count", "normalized", "basemean"]
META_HEADER = r"(?i)gene|symbol|name|id|description|chr|start|end|strand|length|biotype"


def _index(tests: list[Column]) -> Column:
    """First non-missing of several 1-based positions, 0-based; NULL if none."""
    return F.coalesce(*[F.nullif(t, F.lit(0)) for t in tests]).cast("int") - 1


def header_gene_column(header: Column) -> Column:
    """Gene column by its name, else the first column if five values and half of all (of a profile) look like symbols or Ensembl ids."""
    low = F.transform(header, lambda h: F.lower(F.trim(h)))
    named = _index([F.array_position(low, F.lit(n)) for n in GENE_HEADERS])
    enough = F.greatest(F.lit(5), F.col("filled") / 2)
    return F.coalesce(named, F.when((F.col("symbol") >= enough) | (F.col("ensembl") >= enough), 0))


def named_column(header: Column, patterns: list[str]) -> Column:
    """Column equal to a pattern, else one that contains it; blanks and dots count as underscores."""
    low = F.transform(header, lambda h: F.regexp_replace(F.lower(F.trim(h)), r"[ .]", "_"))
    exact = [F.array_position(low, F.lit(p)) for p in patterns]

    def containing(p):
        return F.array_position(F.transform(low, lambda h: F.contains(h, F.lit(p))), F.lit(True))

    return _index(exact + [containing(p) for p in patterns])


def classify(found: DataFrame) -> DataFrame:
    """The profiles with `kind`: deg_list, count_matrix, pathway_table, sample_metadata or other; values are judged over all rows."""
    low = F.transform("header", lambda h: F.lower(F.trim(h)))

    def any_like(pattern):
        return F.exists(low, lambda h: h.rlike(pattern))

    numeric = F.size(F.filter(low, lambda h: ~h.rlike("gene|symbol|name|id|description|chr")))
    is_number = F.col("odd") * 10 <= F.col("n_rows")
    kind = (
        F.when((F.size("header") < 2) | (F.col("n_rows") == 0), "other")
        .when(any_like("log2|fold|logfc") & any_like(r"padj|fdr|pvalue|p\.value|p_value"), "deg_list")
        .when(F.exists(low, lambda h: h.isin(UNIT_HEADERS)), "count_matrix")
        .when((numeric >= 3) & (F.size("header") >= 5) & is_number, "count_matrix")
        .when(any_like("pathway|go_term|kegg|enrichment"), "pathway_table")
        .when(any_like("sample|condition|treatment"), "sample_metadata").otherwise("other"))
    return settle(found.withColumn("kind", kind))


def _by_header(rows: DataFrame) -> DataFrame:
    return _named_at(settle(rows.withColumn("gene_at", header_gene_column(F.col("header")))).where("gene_at IS NOT NULL"))


def deg_rows(rows: DataFrame) -> DataFrame:
    """(path, gene, gene_symbol, log2fc, padj, basemean) of panel rows of differential expression tables."""
    r = _by_header(rows)
    for name, patterns in (("_fc", FOLD_HEADERS), ("_p", PADJ_HEADERS), ("_m", MEAN_HEADERS)):
        r = r.withColumn(name, named_column(F.col("header"), patterns))
    r = settle(r)
    return r.select("path", "gene", "gene_symbol", *[to_double(F.get("cells", F.col(c))).alias(n) for c, n in
                                                     (("_fc", "log2fc"), ("_p", "padj"), ("_m", "basemean"))])


def expression_cells(rows: DataFrame) -> DataFrame:
    """(path, gene, gene_symbol, sample, value) of supplement matrices; annotation columns are no samples."""
    c = _last_cells(_by_header(rows))
    return c.where((F.col("c") != F.col("gene_at")) & ~F.col("sample").rlike(META_HEADER)).select(
        "path", "gene", "gene_symbol", "sample", to_double(F.col("v")).alias("value"))


def preview_markdown(parsed: DataFrame, limit: int | None = None) -> DataFrame:
    """(path, markdown) of each table, of its first `limit` rows where that is given."""
    head = markdown_row(F.transform("header", cell))
    rule = markdown_row(F.transform("header", lambda h: F.lit("---")))
    shown = F.col("rows") if limit is None else F.slice("rows", 1, limit)
    body = F.transform(shown, lambda r: markdown_row(F.transform(r, cell)))
    return parsed.where(F.size("rows") > 0).select(
        "path", F.array_join(F.concat(F.array(head, rule), body), "\n").alias("markdown"))


def wide_cells(lines: DataFrame, keys: list[str], delimiter: str = "\t") -> DataFrame:
    """(path, keys…, column, value) of wide files, whose columns may differ in number and order: cells are named by their own file's header.

    A key column that a file lacks is NULL; empty cells and cells that are no numbers give NULL; cells beyond the header are ignored.
    """
    full = lines.where(F.col("line") != "")
    cut_up = _cut_line if delimiter in DELIMITERS else lambda line, d: cells(line, F.lit(d))
    heads = full.groupBy("path").agg(F.min_by("line", "pos").alias("_head"))
    heads = few(heads.withColumn("_h", cut_up(F.col("_head"), delimiter)))
    rows = settle(full.join(heads, "path").where(F.col("line") != F.col("_head")).select(
        "path", "_h", cut_up(F.col("line"), delimiter).alias("_c")))

    def key(name):
        at = F.array_position("_h", name)
        return F.when(at > 0, F.get("_c", (at - 1).cast("int"))).alias(name)

    n = F.least(F.size("_h"), F.size("_c"))
    pairs = F.arrays_zip(F.slice("_h", F.lit(1), n).alias("column"), F.slice("_c", F.lit(1), n).alias("v"))
    out = rows.select("path", *[key(k) for k in keys], F.inline(F.filter(pairs, lambda p: ~p["column"].isin(keys))))
    return out.select("path", *keys, "column", to_double(F.col("v")).alias("value"))


def aligned(found: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Cells as one wide row per file and keys, with the given columns by name; a column that a file lacks is NULL."""
    return found.groupBy("path", *keys).agg(*[F.max(F.when(F.col("column") == c, F.col("value"))).alias(c) for c in columns])


def integrated(spark: SparkSession, folder: str, keys: list[str]) -> DataFrame:
    """`wide_cells` of the tab-separated matrices below a folder; no rows if there is none."""
    try:
        found = files.lines(spark, folder, "*.{csv,tsv}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.createDataFrame([], "path string, pos struct<block:bigint,at:bigint>, line string")
    return wide_cells(found, keys)
