"""Expression retrieval by stages: each source is read only for what earlier ones left empty."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaymill import dims
from assaymill.operators import retrieval
from assaymill.session import cut
from assaymill.sources import matrix, tables

Tier = Callable[[DataFrame], DataFrame]

SERIES_NAME = r"(GSE\d+)[^/]*_series_matrix"
COUNT_NAME = r"(GSE\d+)_[^/]*$"


def staged(keys: DataFrame, key: list[str], tiers: list[Tier]) -> DataFrame:
    """Rows of the first tier that has any, per key. A tier gets the keys without rows so far and is not run if none is left.

    Each tier's rows and what it leaves are cut, so no tier is computed twice; there are as many jobs as tiers, not keys.
    """
    left, found = cut(keys.select(*key).distinct()), []
    for tier in tiers:
        if found and left.isEmpty():
            break
        rows = cut(tier(left))
        found.append(rows)
        left = cut(left.join(rows.select(*key).distinct(), key, "left_anti"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)


def eligible(papers: DataFrame, rnaseq: DataFrame, values: DataFrame) -> DataFrame:
    """(paper_id, pmc_id, route, unit) of papers with sequencing data and no values yet; route: geo, supplement or text."""
    p = papers.select(F.col("id").alias("paper_id"), "pmc_id", "supplement_dir")
    r = rnaseq.where("has_rnaseq").join(values.select("paper_id").distinct(), "paper_id", "left_anti")
    held = F.coalesce("supplement_dir", F.lit("none")) != "none"
    route = (F.when(F.col("data_availability.classification").isin("geo_with_matrix", "geo_raw_only"), "geo")
             .when(held, "supplement").otherwise("text"))
    return r.join(p, "paper_id").select("paper_id", "pmc_id", route.alias("route"),
                                        F.coalesce(F.nullif("normalization", F.lit("")), F.lit("unknown")).alias("unit"))


class Store(NamedTuple):
    """Lines `(path, pos, line)` of series matrices and of other files of a series, named after it."""
    series: DataFrame
    counts: DataFrame


def _named(lines: DataFrame, pattern: str) -> DataFrame:
    return lines.withColumn("gse_id", F.regexp_extract("path", pattern, 1)).where("gse_id <> ''")


def _file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def _of(lines: DataFrame, paths: DataFrame) -> DataFrame:
    """Lines of the chosen files; the others are dropped before anything is cut up."""
    return lines.join(paths.select("path").distinct(), "path", "left_semi")


def count_files(store: Store) -> DataFrame:
    """(path, gse_id, filename) of the files of series that are no series matrices."""
    found = _named(store.counts.select("path").distinct(), COUNT_NAME).withColumn("filename", _file_name(F.col("path")))
    return cut(found.where(~F.col("filename").contains("_series_matrix")))


def table_cells(lines: DataFrame) -> DataFrame:
    """(path, gene, gene_symbol, sample, value) of panel genes in count tables."""
    return tables.count_cells(tables.panel_rows(lines, tables.profiles(lines)))


def geo_values(todo: DataFrame, accessions: DataFrame, protocols: DataFrame, repository: DataFrame, store: Store,
               lookup: DataFrame | None = None) -> DataFrame:
    """Measurements of papers `(paper_id, unit)` from their series.

    Per series: its matrix; if that names no gene and its platform sequences, its count files. Beside these the files that
    repository records name. Papers without any value: other files of their own series, then of all their series.
    """
    own = retrieval.usable_accessions(accessions.join(todo.select("paper_id"), "paper_id", "left_semi"))
    about = todo.select("paper_id", "unit").join(retrieval.first_protocol(protocols), "paper_id", "left")
    files = count_files(store)

    def measured(cells: DataFrame, path: str, detail: Column, unit: bool = False) -> DataFrame:
        """`cells` (paper_id, gene, sample, value, …) as measurements; other units than the paper's are unknown."""
        known = cells.join(about if unit else about.drop("unit"), "paper_id").withColumn("source_detail", detail)
        keep = [c for c in ("gse_id",) if c in cells.columns]
        rows = retrieval.measurements(known, path, lookup=lookup, carry=keep)
        return rows

    def from_matrices(keys: DataFrame) -> DataFrame:
        lines = _named(store.series, SERIES_NAME).join(keys.select("gse_id").distinct(), "gse_id", "left_semi")
        cells = _named(matrix.gene_cells(matrix.tables(lines.drop("gse_id"))), SERIES_NAME)
        return measured(keys.join(cells, "gse_id"), "series_matrix", F.concat("gse_id", F.lit(" series matrix")), True)

    def from_count_files(keys: DataFrame) -> DataFrame:
        given = accessions.groupBy("gse_id").agg(F.max(F.replace("platform", F.lit("GPL "), F.lit("GPL"))).alias("_given"))
        read = _named(matrix.platforms(store.series), SERIES_NAME).groupBy("gse_id").agg(F.max("platform").alias("_read"))
        j = keys.join(given, "gse_id", "left").join(read, "gse_id", "left")
        sequenced = j.where(F.coalesce("_read", "_given").isin(dims.RNASEQ_PLATFORMS)).select("paper_id", "gse_id")
        wanted = retrieval.candidate_files(files.join(sequenced.select("gse_id").distinct(), "gse_id", "left_semi").withColumn("size", F.lit(0)))
        cells = table_cells(_of(store.counts, wanted)).join(wanted.select("path", "gse_id", "filename"), "path")
        # A later file overrides a sample.
        last = cells.groupBy("gse_id", "gene_symbol", "sample").agg(F.max_by(F.struct("gene", "value"), "filename").alias("x"))
        cells = last.select("gse_id", "sample", "x.gene", "x.value")
        return measured(sequenced.join(cells, "gse_id"), "supplementary", F.concat("gse_id", F.lit(" supplementary")), True)

    def from_other_files(series: DataFrame, path: str, label: str) -> Tier:
        def tier(keys: DataFrame) -> DataFrame:
            tried = repository.join(keys, "paper_id", "left_semi").select("paper_id", F.inline("supplementary_files")).select("paper_id", "filename")
            of_paper = series.join(keys, "paper_id", "left_semi").select("paper_id", "gse_id").distinct()
            wanted = of_paper.join(files, "gse_id").join(tried.distinct(), ["paper_id", "filename"], "left_anti")
            cells = table_cells(_of(store.counts, wanted)).join(wanted, "path")
            detail = F.concat("gse_id", F.lit(f" {label}: "), "filename")
            return measured(cells.withColumn("_detail", detail).drop("gse_id"), path, F.col("_detail"))
        return tier

    named = repository.where("has_processed_matrix").join(todo.select("paper_id"), "paper_id", "left_semi").select(
        "paper_id", "accession", F.inline("supplementary_files")).where("has_count_matrix").select("paper_id", "accession", "filename").distinct()
    listed = store.counts.select("path").distinct().withColumn("filename", _file_name(F.col("path"))).join(named, "filename")
    listed = cut(listed)
    repo = table_cells(_of(store.counts, listed)).join(listed, "path")
    by_series = staged(own.select("paper_id", "gse_id"), ["paper_id", "gse_id"], [from_matrices, from_count_files]).drop("gse_id")
    by_record = measured(repo, "repository", F.concat("accession", F.lit(" supplementary: "), "filename"))
    first = cut(by_series.unionByName(by_record))
    empty = todo.select("paper_id").join(first.select("paper_id").distinct(), "paper_id", "left_anti")
    rest = staged(empty, ["paper_id"], [from_other_files(own, "disk", "disk fallback"),
                                        from_other_files(accessions, "disk_all", "disk fallback (all accs)")])
    return first.unionByName(rest)


def supplement_values(todo: DataFrame, protocols: DataFrame, lines: DataFrame) -> DataFrame:
    """Measurements of papers `(paper_id, pmc_id)` from the tables below their supplement folder: fold changes and matrices."""
    owner = F.regexp_extract("path", r"/(PMC\d+)(?:_supp)?/", 1)
    paths = lines.select("path").distinct().withColumn("pmc_id", owner).join(todo.select("paper_id", "pmc_id"), "pmc_id")
    paths = cut(paths.join(retrieval.first_protocol(protocols), "paper_id", "left").withColumn("filename", _file_name(F.col("path"))))
    own = _of(lines, paths)
    found = cut(tables.classify(tables.profiles(own)).where("kind IN ('deg_list', 'count_matrix')"))
    rows = tables.panel_rows(_of(own, found), found)
    degs = retrieval.deg_measurements(tables.deg_rows(rows.where("kind = 'deg_list'")).join(paths, "path"))
    cells = tables.expression_cells(rows.where("kind = 'count_matrix'")).join(paths, "path").withColumn(
        "source_detail", F.concat(F.lit("Supplement expression: "), "filename"))
    return degs.unionByName(retrieval.measurements(cells, "supplement_matrix"), allowMissingColumns=True)
