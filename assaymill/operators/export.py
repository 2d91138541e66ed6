"""Export sheets, one DataFrame each, and their writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaymill import dims
from assaymill.functions import reagents as R
from assaymill.functions import stages as S
from assaymill.operators import expression as E
from assaymill.operators.joins import left_lookup


def protocols_sheet(protocols: DataFrame, papers: DataFrame) -> DataFrame:
    """One row per protocol with its overview."""
    p = papers.select(F.col("id").alias("paper_id"), "pmc_id", "doi", "title")
    j = protocols.withColumnRenamed("id", "protocol_id").join(p, "paper_id")
    ea = F.col("endpoint_assessment")
    return j.select(
        "protocol_id", "pmc_id", "doi", "title", F.col("protocol_arm").alias("arm"),
        F.col("cell_source.type").alias("cell_type"), F.col("cell_source.line_name").alias("cell_line"),
        F.col("cell_source.organism").alias("organism"), F.col("culture_system.format").alias("culture_format"),
        F.col("culture_system.substrate").alias("substrate"), F.col("culture_system.oxygen_condition").alias("o2"),
        F.coalesce(F.size("stages"), F.lit(0)).alias("num_stages"),
        F.col("extraction_confidence").alias("confidence"), F.col("pass_number").alias("pass"),
        F.when(F.col("is_optimized"), "Yes").otherwise("No").alias("optimized"),
        R.markers(ea["markers"]).alias("endpoint_markers"),
        R.assays(ea["functional_assays"]).alias("functional_assays"))


def stages_sheet(protocols: DataFrame, papers: DataFrame) -> DataFrame:
    """One row per stage with its reagents."""
    p = papers.select(F.col("id").alias("paper_id"), "pmc_id")
    j = protocols.select(F.col("id").alias("protocol_id"), "paper_id", F.posexplode("stages").alias("pos", "s"))

    def listed(c):
        return R.reagents(F.col(f"s.{c}"), unit="concentration_unit").alias(c)

    return j.join(p, "paper_id").select(
        "protocol_id", "pmc_id", (F.col("pos") + 1).alias("stage_no"), F.col("s.stage_name").alias("stage_name"),
        F.col("s.duration_days").alias("duration_days"), F.col("s.base_medium").alias("base_medium"),
        listed("growth_factors"), listed("small_molecules"), listed("supplements"),
        F.col("s.seeding_density").alias("seeding_density"),
        F.col("s.medium_change_frequency").alias("medium_change_frequency"),
        R.markers(F.col("s.stage_markers")).alias("stage_markers"))


def stage_expression_rows(values: DataFrame, protocols: DataFrame, papers: DataFrame) -> DataFrame:
    """(protocol, day, gene) means with the stage active on that day (days past the end have none)."""
    m = E.day_means(values)
    pr = protocols.withColumn("ranges", S.stage_ranges(F.col("stages"))).select(
        F.col("id").alias("protocol_id"), F.col("paper_id").alias("_pp"), "ranges")
    p = papers.select(F.col("id").alias("_pp"), "pmc_id")
    j = m.join(pr, "protocol_id", "left").join(p, "_pp", "left")
    hit = S.day_to_stage(F.col("time_point_day"), F.col("ranges"), overflow=False)
    return j.withColumn("_s", hit).select(
        "protocol_id", "pmc_id", "time_point_day", "gene_symbol", "value", "unit", "condition_label",
        F.coalesce("_s.stage_name", F.lit("")).alias("stage_name"), F.col("_s.stage_number").alias("stage_no"))


def stage_expression_sheet(values: DataFrame, protocols: DataFrame, papers: DataFrame,
                           columns: list[str] | None = None) -> DataFrame:
    """(protocol, day) rows: paper, arm, the active stage's medium and reagents, and a column per gene."""
    wide = E.day_means(values).groupBy("protocol_id", "time_point_day").agg(
        F.min("unit").alias("unit"), F.min("condition_label").alias("condition"),
        *[F.max(F.when(F.col("gene_symbol") == g, F.col("value"))).alias(g) for g in columns or dims.PANEL])
    pr = protocols.withColumn("ranges", S.stage_ranges(F.col("stages"))).select(
        F.col("id").alias("protocol_id"), "paper_id", "protocol_arm", "cell_source", "culture_system", "stages", "ranges")
    p = papers.select(F.col("id").alias("paper_id"), "pmc_id", "doi")
    j = wide.join(pr, "protocol_id").join(p, "paper_id")
    hit = S.day_to_stage(F.col("time_point_day"), F.col("ranges"), overflow=False)
    j = j.withColumn("_s", F.get("stages", hit["stage_number"] - 1))

    def listed(c):
        return R.reagents(F.col(f"_s.{c}"), unit="concentration_unit").alias(c)

    return j.select(
        "protocol_id", "pmc_id", "doi", F.col("protocol_arm").alias("arm"), F.col("cell_source.type").alias("cell_type"),
        F.col("cell_source.line_name").alias("cell_line"), F.col("culture_system.format").alias("culture_format"),
        F.col("time_point_day").alias("day"), "condition", F.coalesce("_s.stage_name", F.lit("")).alias("stage_name"),
        F.coalesce("_s.base_medium", F.lit("")).alias("base_medium"), listed("growth_factors"),
        listed("small_molecules"), listed("supplements"), "unit", *(columns or dims.PANEL))


def all_expression_sheet(values: DataFrame, papers: DataFrame, protocols: DataFrame) -> DataFrame:
    """One row per measurement with its paper and arm."""
    p = papers.select(F.col("id").alias("paper_id"), "pmc_id", "doi")
    pr = protocols.select(F.col("id").alias("protocol_id"), "protocol_arm")
    columns = ["gene_symbol", "value", "unit", "condition_label", "time_point_day", "comparison", "padj",
               "source_type", "source_detail", "confidence"]
    return left_lookup(values.join(p, "paper_id"), pr, ["protocol_id"]).select(
        "pmc_id", "doi", "protocol_arm", *[c for c in columns if c in values.columns])


def rnaseq_sheet(rnaseq: DataFrame, papers: DataFrame) -> DataFrame:
    """One row per paper with its RNA-seq description; differential counts of 0 show as missing."""
    p = papers.select(F.col("id").alias("paper_id"), "pmc_id", "doi", "title")

    def total(field):
        return F.nullif(F.aggregate(
            F.coalesce(F.col("deg_summary.comparisons"), F.array()), F.lit(0),
            lambda acc, c: acc + F.coalesce(c[field], F.lit(0))), F.lit(0))

    names = F.filter(F.transform("accessions", lambda a: a["accession"]), lambda a: a != "")
    return rnaseq.join(p, "paper_id").select(
        "pmc_id", "doi", "title", F.when(F.col("has_rnaseq"), "Yes").otherwise("No").alias("has_rnaseq"),
        "technology", "library_prep", "read_type", "genome_build", "alignment_tool", "quantification_tool",
        "normalization", total("n_up").alias("deg_up"), total("n_down").alias("deg_down"),
        F.coalesce(F.array_join(names, "; "), F.lit("")).alias("accessions"),
        F.coalesce("data_availability.repository", F.lit("")).alias("data_availability"))


def repository_sheet(records: DataFrame, papers: DataFrame) -> DataFrame:
    p = papers.select(F.col("id").alias("paper_id"), "pmc_id", "doi")
    return records.join(p, "paper_id").select(
        "pmc_id", "doi", "accession", "repository", "project_title", "organism", "data_type", "platform",
        "sample_count", F.when(F.col("has_processed_matrix"), "Yes").otherwise("No").alias("has_processed_matrix"),
        "fetch_status")


# -- writers ---------------------------------------------------------------------------------------------------

# Sheets that are written even when empty.
ALWAYS = {"protocols", "stages", "protocol_matrix"}


def write_sheets(sheets: dict[str, DataFrame], folder: str, fmt: str = "parquet") -> list[str]:
    """Write each sheet below `folder`; all but the basic ones only if they hold rows. Returns what was written."""
    written = []
    for name, df in sheets.items():
        if name in ALWAYS or df.take(1):
            w = df.write.mode("overwrite")
            (w.option("header", True).csv(f"{folder}/{name}") if fmt == "csv" else w.parquet(f"{folder}/{name}"))
            written.append(name)
    return written


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)


def append_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_texts(df: DataFrame, path: str, key: str = "pmc_id", text: str = "text") -> None:
    """Texts keyed by paper as JSON lines; a million small files would serve no reader."""
    df.select(key, text).write.mode("overwrite").json(path)
