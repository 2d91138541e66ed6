"""Expression retrieval: matrices and tables to measurement rows, best source first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaymill import dims
from assaymill.functions import accessions as A
from assaymill.functions import genes
from assaymill.functions import text as T
from assaymill.operators.ranking import top_per_group


def usable_accessions(accessions: DataFrame) -> DataFrame:
    """A paper's own series, or all of its series if none is its own."""
    own = accessions.groupBy("paper_id").agg(F.bool_or(F.col("context") == "own_data").alias("_own"))
    return (accessions.join(own, "paper_id")
            .where(~F.coalesce("_own", F.lit(False)) | (F.col("context") == "own_data")).drop("_own"))


def first_protocol(protocols: DataFrame) -> DataFrame:
    """The protocol a paper's measurements attach to."""
    return protocols.groupBy("paper_id").agg(F.min("id").alias("protocol_id"))


def best_probe(rows: DataFrame) -> DataFrame:
    """Of several probes of a gene `(file, gene_symbol, probe, pos, samples, values)` the rows of the one with the highest mean.

    Means are aggregated per probe from the rows' arrays, before these are spread into cells; ties and probes without numbers go to
    the first in the file.
    """
    known = F.filter("values", lambda v: v.isNotNull())
    sums = rows.select("file", "gene_symbol", "probe", "pos", F.aggregate(known, F.lit(0.0), lambda a, v: a + v).alias("_sum"), F.size(known).alias("_n"))
    means = sums.groupBy("file", "gene_symbol", "probe").agg(F.sum("_sum").alias("_sum"), F.sum("_n").alias("_n"), F.min("pos").alias("_pos"))
    worst = F.lit(float("-inf"))
    mean = F.when(F.col("_n") > 0, F.col("_sum") / F.col("_n")).otherwise(worst)
    best = means.groupBy("file", "gene_symbol").agg(F.min(F.struct((-mean).alias("m"), F.col("_pos").alias("p"), "probe")).alias("b"))
    best = best.select("file", "gene_symbol", F.col("b.probe").alias("probe"))
    return rows.join(best, ["file", "gene_symbol", "probe"], "left_semi")


def merge_files(rows: DataFrame, wide_samples: int = 500) -> DataFrame:
    """Values of a series merged over its files `(gse_id, file_no, gene_symbol, sample, value)`.

    A later file overrides a sample. `wide` marks the series in which some gene has more than `wide_samples` samples, as
    single-cell data has; no row is dropped for it.
    """
    merged = rows.groupBy("gse_id", "gene_symbol", "sample").agg(
        F.max_by(F.struct(F.col("value").alias("v")), "file_no")["v"].alias("value"))
    wide = (merged.groupBy("gse_id", "gene_symbol").agg(F.count(F.lit(1)).alias("c"))
            .groupBy("gse_id").agg((F.max("c") > wide_samples).alias("wide")))
    return merged.join(wide, "gse_id")


def candidate_files(files: DataFrame, max_files: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """Files of a series worth parsing `(gse_id, filename, size)`: count-like tables, else any packed table.

    All of them, unless a number per series (in listing order) or a size is given.
    """
    f = files.where(~F.col("filename").rlike(A.SKIP_FILE))
    f = f.withColumn("_named", F.col("filename").rlike(A.TABULAR_FILE) & F.col("filename").rlike(A.COUNT_FILE))
    any_named = f.groupBy("gse_id").agg(F.bool_or("_named").alias("_any"))
    f = f.join(any_named, "gse_id").where(
        F.when(F.col("_any"), F.col("_named")).otherwise(F.col("filename").rlike(A.PACKED_TABULAR_FILE)))
    if max_files is not None:
        f = top_per_group(f, ["gse_id"], ["filename"], max_files, ["filename"])
    if max_bytes is not None:
        f = f.where(F.coalesce("size", F.lit(0)) <= max_bytes)
    return f.drop("_named", "_any")


def measurements(cells: DataFrame, path: str, unit: str | None = None, lookup: DataFrame | None = None,
                 carry: list[str] | None = None) -> DataFrame:
    """Matrix cells `(paper_id, protocol_id, gene, sample, value, source_detail[, unit])` as measurement rows.

    Missing values are dropped, the gene gets its symbol, the sample its stage; the path sets the confidence. Columns named in `carry` stay.
    """
    symbol = genes.resolve_alias(F.col("gene"))
    c = cells.where(F.col("value").isNotNull())
    if lookup is not None:
        look = lookup.select("protocol_id", F.col("sample_key").alias("sample"),
                             F.col("condition_label").alias("_label"), F.col("time_point_day").alias("_day"))
        c = c.join(look, ["protocol_id", "sample"], "left")
    else:
        c = c.withColumn("_label", F.lit(None).cast("string")).withColumn("_day", F.lit(None).cast("int"))
    given = F.col("unit") if "unit" in cells.columns else F.lit(unit or "unknown")
    kind = "supplement_table" if path in ("deg", "supplement_matrix") else "geo_matrix"
    return c.select(
        *(carry or []), "paper_id", "protocol_id", symbol.alias("gene_symbol"),
        F.when(F.col("gene") != symbol, F.col("gene")).alias("gene_alias"), "value",
        F.coalesce(given, F.lit("unknown")).alias("unit"),
        F.coalesce(F.nullif(F.col("_label"), F.lit("")), F.col("sample")).alias("condition_label"),
        F.col("_day").alias("time_point_day"), F.lit(kind).alias("source_type"), "source_detail",
        F.lit(dims.SOURCE_CONFIDENCE[path]).alias("confidence"))


def deg_measurements(degs: DataFrame) -> DataFrame:
    """Differential expression rows `(paper_id, protocol_id, filename, gene, log2fc, padj)` as measurements."""
    return degs.where(F.col("log2fc").isNotNull()).select(
        "paper_id", "protocol_id", genes.resolve_alias(F.col("gene")).alias("gene_symbol"),
        F.col("log2fc").alias("value"), F.lit("log2FC").alias("unit"),
        T.comparison_label(F.col("filename")).alias("comparison"), "padj",
        F.lit("supplement_table").alias("source_type"),
        F.concat(F.lit("Supplement DEG: "), "filename").alias("source_detail"),
        F.lit(dims.SOURCE_CONFIDENCE["deg"]).alias("confidence"))


def markers_by_paper(values: DataFrame, papers: DataFrame) -> DataFrame:
    """Marker records keyed by paper, one JSON object per row; written partitioned, never gathered per paper."""
    p = papers.select(F.col("id").alias("paper_id"), "pmc_id")
    return values.join(p, "paper_id").select(
        "pmc_id", F.to_json(F.struct("paper_id", "gene_symbol", "value", "unit", "condition_label", "source_type",
                                     "confidence")).alias("marker"))
