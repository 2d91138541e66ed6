"""Series matrices and platform annotations by lines: `(path, pos, line)` in, long cells out.

A file may be of any size: its lines are read by many tasks (`files.lines`). One narrow pass keeps the few lines that matter (header
marks, and rows named by a panel gene or a wanted probe); only those meet the file's header again.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaymill.functions import genes
from assaymill.functions.numbers import to_double, unquote, unquote_all
from assaymill.session import cut, few, settle

# Line starts of the table's header and end, and of the header lines that are read.
HEAD, END = '"ID_REF"', "!series_matrix_table_end"
PLATFORM, SAMPLE_IDS, SAMPLE_TITLES = "!Series_platform_id", "!Sample_geo_accession", "!Sample_title"


class Series(NamedTuple):
    """frames: (path, head, end, samples, platform), one row per file with a table. body: (path, pos, line, key, gene, samples, platform) of kept rows in it."""
    frames: DataFrame
    body: DataFrame


def _values(line: Column) -> Column:
    """Cells of a tab line after its first, unquoted."""
    parts = F.split(line, "\t")
    return unquote_all(F.slice(parts, F.lit(2), F.size(parts)))


def _key(line: Column) -> Column:
    return unquote(F.substring_index(line, "\t", 1))


def _first(test: Column) -> Column:
    """Position and text of the first line that passes."""
    return F.min(F.when(test, F.struct("pos", "line")))


def tables(lines: DataFrame, probes: DataFrame | None = None) -> Series:
    """The tables between their header and their end mark or first blank line; of their rows those named by a panel gene, and
    those of `probes` (platform, probe, gene_symbol) where given.
    """
    line = F.col("line")
    is_end = (F.trim(line) == "") | line.startswith(END)
    kept = settle(lines.select("path", "pos", "line", _key(line).alias("key"), is_end.alias("is_end")))
    kept = settle(kept.withColumn("gene", F.coalesce(genes.is_target_gene(F.col("key")), F.lit(False))))
    wanted = F.col("gene") | F.col("is_end") | line.startswith(HEAD) | line.startswith(PLATFORM)
    if probes is not None:
        ids = few(probes.select(F.col("probe").alias("key"), F.lit(True).alias("probe")).distinct())
        kept = kept.join(ids, "key", "left")
        wanted = wanted | F.col("probe")
        kept = kept.select("path", "pos", "line", "key", "is_end", "gene", F.coalesce("probe", F.lit(False)).alias("probe"))
    kept = cut(kept.where(wanted))
    marks = kept.where(line.startswith(HEAD) | line.startswith(PLATFORM)).groupBy("path").agg(_first(line.startswith(HEAD)).alias("h"), _first(line.startswith(PLATFORM)).alias("p")).where("h IS NOT NULL")
    heads = marks.select("path", F.col("h.pos").alias("head"), _values(F.col("h.line")).alias("samples"), F.when(
        F.col("p.pos") <= F.col("h.pos"), F.nullif(F.regexp_extract("p.line", r"GPL\d+", 0), F.lit(""))).alias("platform"))
    ends = kept.where("is_end").select(F.col("path").alias("_of"), F.col("pos").alias("_end"))
    frames = cut(heads.join(ends, (F.col("_of") == F.col("path")) & (F.col("_end") > F.col("head")), "left").groupBy("path").agg(
        F.first("head").alias("head"), F.first("samples").alias("samples"), F.first("platform").alias("platform"), F.min("_end").alias("end")))
    rows = kept.where(F.col("gene") if probes is None else F.col("gene") | F.col("probe"))
    inside = (F.col("pos") > F.col("head")) & (F.col("end").isNull() | (F.col("pos") < F.col("end")))
    body = rows.join(frames, "path").where(inside).select("path", "pos", "line", "key", "gene", "samples", "platform")
    return Series(frames, body)


def platforms(lines: DataFrame) -> DataFrame:
    """(path, platform) from the header lines of series matrices."""
    first = lines.where(F.col("line").startswith(PLATFORM)).groupBy("path").agg(F.min_by("line", "pos").alias("line"))
    return first.select("path", F.nullif(F.regexp_extract("line", r"GPL\d+", 0), F.lit("")).alias("platform"))


def sample_titles(lines: DataFrame) -> DataFrame:
    """(path, gsm_id, title) from the two header lines that list them side by side."""
    line = F.col("line")
    marks = lines.where(line.startswith(HEAD) | line.startswith(SAMPLE_IDS) | line.startswith(SAMPLE_TITLES))
    first = marks.groupBy("path").agg(_first(line.startswith(HEAD)).alias("h"), _first(line.startswith(SAMPLE_IDS)).alias("i"),
                                      _first(line.startswith(SAMPLE_TITLES)).alias("t"))

    def before(name):
        return F.when(F.col("h").isNull() | (F.col(f"{name}.pos") < F.col("h.pos")), F.col(f"{name}.line"))

    pairs = F.arrays_zip(_values(before("i")).alias("gsm_id"), _values(before("t")).alias("title"))
    return first.select("path", F.inline(pairs)).where(
        (F.coalesce("gsm_id", F.lit("")) != "") & (F.coalesce("title", F.lit("")) != ""))


def _with_values(rows: DataFrame) -> DataFrame:
    """Rows `(…, samples, line)` with their numbers as `values` beside as many samples; cells beyond the header are ignored."""
    n = F.least(F.size("samples"), F.size("values"))
    return settle(rows.withColumn("values", _values(F.col("line"))).drop("line")).withColumns(
        {"samples": F.slice("samples", F.lit(1), n), "values": F.transform(F.slice("values", F.lit(1), n), to_double)})


def cells(rows: DataFrame) -> DataFrame:
    """Rows `(…, samples, values)` as one row per sample with its value."""
    keep = [c for c in rows.columns if c not in ("samples", "values")]
    return rows.select(*keep, F.inline(F.arrays_zip(F.col("samples").alias("sample"), F.col("values").alias("value"))))


def gene_cells(series: Series) -> DataFrame:
    """(path, gene, gene_symbol, sample, value) of rows named by gene; of a gene listed twice the last row counts."""
    r = series.body.where("gene").withColumn("gene_symbol", genes.resolve_alias(F.col("key")))
    last = r.groupBy("path", "gene_symbol").agg(F.max_by(F.struct(F.col("key").alias("gene"), "line", "samples"), "pos").alias("x"))
    return cells(_with_values(last.select("path", "x.gene", "gene_symbol", "x.line", "x.samples")))


def probe_rows(series: Series, probes: DataFrame) -> DataFrame:
    """(file, gene_symbol, probe, pos, samples, values) of files without gene rows, through `(platform, probe, gene_symbol)`.

    `series` must have been read with the same probes.
    """
    named = series.body.where("gene").select("path").distinct()
    r = series.body.withColumnRenamed("key", "probe").join(few(probes), ["platform", "probe"]).join(named, "path", "left_anti")
    return _with_values(r.select(F.col("path").alias("file"), "gene_symbol", "probe", "pos", "samples", "line"))


# Annotation column names with symbols, and with longer assignments.
SYMBOL_COLUMNS = ["gene symbol", "gene_symbol", "symbol", "gene.symbol", "genesymbol", "orf", "gene_name",
                  "gene name", "ilmn_gene"]
ASSIGNMENT_COLUMNS = ["gene_assignment", "gene assignment", "mrna_assignment"]


def probe_genes(annotations: DataFrame) -> DataFrame:
    """(platform, probe, gene_symbol) from annotation lines `(platform, pos, line)`; panel genes only.

    A probe takes the first panel gene in its symbol columns, else in its assignment columns. Only header candidates and lines
    that name a panel gene anywhere are kept for that.
    """
    line = F.col("line")
    body = annotations.where(~line.rlike(r"^[#!^]") & (line != ""))
    lowered = F.transform(F.split(F.lower(line), "\t"), unquote)
    named = F.exists(F.split(line, r"[;/|,\s\"]+"), lambda t: F.coalesce(genes.is_target_gene(t), F.lit(False)))
    kept = cut(body.select("platform", "pos", "line", F.array_contains(lowered, "id").alias("is_head"), named.alias("named")).where("is_head OR named"))
    heads = kept.where("is_head").groupBy("platform").agg(F.min("pos").alias("head"), F.min_by("line", "pos").alias("h"))
    heads = heads.withColumn("h", F.transform(F.split(F.lower("h"), "\t"), unquote))

    def places(names):
        spots = F.transform("h", lambda h, i: F.when(h.isin(names), i))
        return F.filter(spots, lambda i: i.isNotNull())

    heads = heads.select("platform", "head", (F.array_position("h", "id") - 1).cast("int").alias("id"),
                         F.concat(places(SYMBOL_COLUMNS), places(ASSIGNMENT_COLUMNS)).alias("order"))
    r = kept.where("named").join(heads, "platform").where(F.col("pos") > F.col("head"))
    r = r.withColumn("c", F.transform(F.split("line", "\t"), unquote))
    names = F.flatten(F.transform("order", lambda i: F.split(F.coalesce(F.get("c", i), F.lit("")), r"[;/|,\s]+")))
    first = F.get(F.filter(names, lambda t: F.coalesce(genes.is_target_gene(t), F.lit(False))), F.lit(0))
    r = r.select("platform", "pos", F.get("c", F.col("id")).alias("probe"), genes.resolve_alias(first).alias("gene_symbol"))
    r = r.where("gene_symbol IS NOT NULL AND probe IS NOT NULL")
    return r.groupBy("platform", "probe").agg(F.max_by("gene_symbol", "pos").alias("gene_symbol"))
