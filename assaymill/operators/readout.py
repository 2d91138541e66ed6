"""Readout analysis: aggregate, trajectories, ranking, optimal days, figure data."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assaymill import dims
from assaymill.functions import genes
from assaymill.functions.genes import literal_map
from assaymill.operators import ranking
from assaymill.operators.expression import panel_values
from assaymill.session import cut

KEYS = ["protocol_id", "pmc_id", "doi", "protocol_arm", "gene_symbol", "time_point_day", "unit"]


def aggregate(values: DataFrame, papers: DataFrame, protocols: DataFrame) -> DataFrame:
    """Mean, count, deviation and top confidence per protocol, gene, day and unit.

    Measurements shrink to one row per key before they meet papers and protocols. Rows that lack any
    key, the paper's DOI and the protocol's arm included, do not take part.
    """
    v = panel_values(values).where(
        F.col("protocol_id").isNotNull() & F.col("time_point_day").isNotNull() & F.col("unit").isNotNull())
    small = v.groupBy("paper_id", "protocol_id", "gene_symbol", "time_point_day", "unit").agg(
        F.avg("value").alias("mean_value"), F.count("value").alias("n_replicates"),
        F.stddev_samp("value").alias("std_value"), F.max("confidence").alias("confidence"))
    p = papers.select(F.col("id").alias("paper_id"), "pmc_id", "doi").dropna()
    pr = protocols.select(F.col("id").alias("protocol_id"), "protocol_arm").dropna()
    return (small.join(p, "paper_id").join(pr, "protocol_id")
            .select(*KEYS, "mean_value", "n_replicates", "std_value", "confidence"))


def trajectories(agg: DataFrame, min_days: int = 2) -> DataFrame:
    """First, last, peak and range of every (protocol, gene) series, and whether it moves as expected."""
    days = agg.groupBy("protocol_id").agg(F.countDistinct("time_point_day").alias("d"))
    points = agg.join(days.where(F.col("d") >= min_days), "protocol_id", "left_semi")
    at = F.struct(F.col("time_point_day").alias("day"), F.col("unit").alias("u"), F.col("pmc_id").alias("p"),
                  F.col("mean_value").alias("v"))
    peak = F.struct((-F.col("mean_value")).alias("neg"), F.col("time_point_day").alias("day"))
    t = points.groupBy("protocol_id", "gene_symbol").agg(
        F.min(at).alias("first"), F.max(at).alias("last"),
        F.count(F.lit(1)).alias("n_timepoints"),
        F.max("mean_value").alias("max_value"), F.min("mean_value").alias("min_value"),
        F.avg("mean_value").alias("_mean"),
        F.min(F.when(F.col("mean_value").isNotNull(), peak)).alias("_peak"),
    ).where((F.col("n_timepoints") >= 2) & F.col("max_value").isNotNull())

    first, last = F.col("first.v"), F.col("last.v")
    change = (F.when((first > 0) & (last > 0), last / F.nullif(first, F.lit(0.0)))
              .when((first == 0) & (last > 0), last)
              .when((first > 0) & (last == 0), F.lit(1.0) / F.nullif(first, F.lit(0.0)))
              .otherwise(F.lit(1.0)))
    t = t.select(
        "protocol_id", F.col("first.p").alias("pmc_id"), "gene_symbol",
        F.col("first.day").alias("first_day"), F.col("last.day").alias("last_day"), "n_timepoints",
        first.alias("first_value"), last.alias("last_value"), "max_value", "min_value",
        F.col("_peak.day").alias("peak_day"), change.alias("fold_change"), "_mean",
        (F.col("max_value") - F.col("min_value")).alias("dynamic_range"),
        genes.expected_direction(F.col("gene_symbol")).alias("expected_direction"),
        F.col("first.u").alias("unit"))
    t = t.withColumn("log2fc", F.log2("fold_change"))
    d = F.col("expected_direction")
    follows = (F.when(d == "down", F.col("log2fc") < -0.5)
               .when(d == "up", F.col("log2fc") > 0.5)
               .when(d == "transient_up", (F.col("peak_day") < F.col("last_day"))
                     & (F.col("max_value") > F.col("first_value") * 1.5))
               .when(d == "low", F.col("max_value") < F.col("_mean") * 2)
               .otherwise(F.lit(True)))
    return t.withColumn("follows_expected", F.coalesce(follows, F.lit(False))).drop("_mean")


def rank_readouts(traj: DataFrame, agg: DataFrame) -> DataFrame:
    """Genes by composite score of consistency, fold change, coverage and range.

    A gene's series are a 47th of all at least, so its medians are taken by position, not in a buffer.
    """
    traj = traj.select("gene_symbol", "protocol_id", "follows_expected", "dynamic_range", F.abs("log2fc").alias("_abs"))
    stats = traj.groupBy("gene_symbol").agg(
        F.countDistinct("protocol_id").alias("n_protocols_temporal"),
        F.sum(F.col("follows_expected").cast("int")).alias("n_follow_expected"),
        F.avg("_abs").alias("mean_abs_log2fc"))
    both = traj.select("gene_symbol", F.inline(F.array(
        F.struct(F.lit("fold").alias("_which"), F.col("_abs").alias("_value")), F.struct(F.lit("span").alias("_which"), F.col("dynamic_range").alias("_value")))))
    medians = ranking.grouped_median(both, ["gene_symbol", "_which"], "_value", "_median").groupBy("gene_symbol").agg(
        F.max(F.when(F.col("_which") == "fold", F.col("_median"))).alias("median_abs_log2fc"),
        F.max(F.when(F.col("_which") == "span", F.col("_median"))).alias("median_dynamic_range"))
    total = agg.groupBy("gene_symbol").agg(F.countDistinct("protocol_id").alias("n_protocols_total"))
    g = stats.join(medians, "gene_symbol").join(total, "gene_symbol")
    g = g.withColumn("category", genes.category(F.col("gene_symbol")))
    g = g.withColumn("expected_direction", genes.expected_direction(F.col("gene_symbol")))
    g = g.withColumn("consistency", F.col("n_follow_expected") / F.col("n_protocols_temporal"))
    weight = F.coalesce(F.try_element_at(literal_map(dims.DIRECTION_WEIGHT), F.col("expected_direction")), F.lit(0.5))

    def capped(c, at):
        return F.least(F.col(c) / F.lit(float(at)), F.lit(1.0))

    score = (F.col("consistency") * 0.30 * weight + capped("median_abs_log2fc", 5) * 0.35
             + capped("n_protocols_temporal", 20) * 0.20 + capped("median_dynamic_range", 1000) * 0.15)
    g = g.withColumn("composite_score", score)
    # At most one row per panel gene is left here.
    by_score = Window.partitionBy(F.lit(0)).orderBy(F.desc("composite_score"), "gene_symbol")
    return g.withColumn("rank", F.row_number().over(by_score)).select(
        "rank", "gene_symbol", "category", "expected_direction", "n_protocols_temporal", "n_protocols_total",
        "consistency", "n_follow_expected", "median_abs_log2fc", "mean_abs_log2fc", "median_dynamic_range",
        "composite_score")


def timepoints(traj: DataFrame, agg: DataFrame) -> DataFrame:
    """Per gene and day statistics over protocols, with the best day to measure marked."""
    known = traj.select("gene_symbol").distinct()
    s = agg.join(known, "gene_symbol", "left_semi").groupBy("gene_symbol", "time_point_day").agg(
        F.avg("mean_value").alias("mean_value"), F.stddev_samp("mean_value").alias("std_value"),
        F.countDistinct("protocol_id").alias("n_protocols")).where(F.col("n_protocols") >= 2)
    s = s.withColumn("expected_direction", genes.expected_direction(F.col("gene_symbol")))
    s = s.withColumn("cv", F.col("std_value") / F.nullif(F.col("mean_value"), F.lit(0.0)))
    d = F.col("expected_direction")
    key = (F.when(d.isin("up", "transient_up"), -F.col("mean_value")).when(d == "down", F.col("mean_value"))
           .otherwise(-F.col("n_protocols").cast("double")))
    # (gene, day) rows: a few thousand at most.
    best = Window.partitionBy("gene_symbol").orderBy(key.asc_nulls_last(), "time_point_day")
    return s.withColumn("_rn", F.row_number().over(best)).select(
        "gene_symbol", "expected_direction", F.col("time_point_day").alias("day"), "mean_value", "std_value", "cv",
        "n_protocols", (F.col("_rn") == 1).alias("is_optimal_day"))


def heatmap(agg: DataFrame, ranked: DataFrame, top: int | None = None, last_day: int | None = None) -> DataFrame:
    """Row-normalised mean expression of the readouts by day, long form; of the `top` ones or up to a day where asked."""
    genes_top = (ranked if top is None else ranked.where(F.col("rank") <= top)).select("gene_symbol", "rank")
    m = ((agg if last_day is None else agg.where(F.col("time_point_day") <= last_day))
         .groupBy("gene_symbol", "time_point_day").agg(F.avg("mean_value").alias("mean_value")))
    peak = m.groupBy("gene_symbol").agg(F.max("mean_value").alias("_top"))
    return (m.join(peak, "gene_symbol").join(genes_top, "gene_symbol")
            .select("rank", "gene_symbol", F.col("time_point_day").alias("day"), "mean_value",
                    (F.col("mean_value") / F.nullif(F.col("_top"), F.lit(0.0))).alias("relative")))


# Marker genes of the trajectory figure.
FIGURE_GENES = ["POU5F1", "NANOG", "SOX17", "FOXA2", "HNF4A", "AFP", "ALB", "CYP3A4"]


def within_protocol_profile(agg: DataFrame, genes_shown: list[str] | None = None, min_days: int = 3,
                            last_day: int | None = None) -> DataFrame:
    """Mean and deviation over protocols of each protocol's own max-normalised series, per gene and day.

    All genes and days, unless some genes (`FIGURE_GENES` for the trajectory figure) or a last day are given.
    """
    long_enough = (agg.groupBy("protocol_id").agg(F.countDistinct("time_point_day").alias("d"))
                   .where(F.col("d") >= min_days))
    m = ((agg if genes_shown is None else agg.where(F.col("gene_symbol").isin(genes_shown))).join(long_enough, "protocol_id", "left_semi")
         .groupBy("gene_symbol", "protocol_id", "time_point_day").agg(F.avg("mean_value").alias("mean_value")))
    top = m.groupBy("gene_symbol", "protocol_id").agg(F.max("mean_value").alias("_top"))
    n = m.join(top, ["gene_symbol", "protocol_id"]).withColumn(
        "_norm", F.when(F.col("_top") > 0, F.col("mean_value") / F.nullif(F.col("_top"), F.lit(0.0)))
        .otherwise(F.lit(0.0)))
    return ((n if last_day is None else n.where(F.col("time_point_day") <= last_day)).groupBy("gene_symbol", "time_point_day")
            .agg(F.avg("_norm").alias("mean_norm"), F.stddev_samp("_norm").alias("std_norm")))


def analyze(values: DataFrame, papers: DataFrame, protocols: DataFrame) -> dict[str, DataFrame]:
    """All readout tables. The aggregate, far smaller than the measurements, is written once for its readers."""
    agg = cut(aggregate(values, papers, protocols))
    traj = trajectories(agg)
    ranked = rank_readouts(traj, agg)
    points = timepoints(traj, agg)
    return {"aggregate": agg, "trajectories": traj, "ranking": ranked, "timepoints": points,
            "heatmap": heatmap(agg, ranked), "profile": within_protocol_profile(agg),
            "summary": summary(agg, ranked, points)}


def summary(agg: DataFrame, ranked: DataFrame, points: DataFrame) -> DataFrame:
    """Lines of the text summary, in order."""
    head = agg.agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("protocol_id").alias("p"),
        F.countDistinct("gene_symbol").alias("g")).select(F.explode(F.array(
            F.struct(F.lit(0).alias("part"), F.lit(0).alias("pos"),
                     F.format_string("Total aggregated measurements: %,d", "n").alias("line")),
            *[F.struct(F.lit(0).alias("part"), F.lit(pos).alias("pos"), F.format_string(text, column).alias("line")) for pos, text, column in [
                (1, "Protocols with expression data: %d", "p"), (2, "Genes in panel: %d", "g"),
                (3, "Protocols with temporal (multi-day) data: %d", "p")]],
        )).alias("x")).select("x.*")
    top = ranked.where(F.col("rank") <= 10).select(
        F.lit(1).alias("part"), F.col("rank").alias("pos"),
        F.format_string(
            "  %2d. %-10s category=%-22s score=%.3f consistency=%.0f%% |log2FC|=%.2f n_protos=%d",
            "rank", "gene_symbol", "category", "composite_score", F.col("consistency") * 100,
            "median_abs_log2fc", "n_protocols_temporal").alias("line"))
    best = points.where("is_optimal_day").select(
        F.lit(2).alias("part"), F.lit(0).alias("pos"),
        F.format_string("  %-10s → day %3d (mean=%.1f, CV=%.2f, n_protocols=%d)", "gene_symbol", "day",
                        "mean_value", "cv", "n_protocols").alias("line"))
    # How many genes of each direction are named.
    shown = {"up": 5, "down": 3, "transient_up": 3}
    w = Window.partitionBy("expected_direction").orderBy("rank")
    named = (ranked.where(F.col("expected_direction").isin(*shown)).withColumn("_k", F.row_number().over(w))
             .where(F.col("_k") <= F.try_element_at(literal_map(shown), F.col("expected_direction")))
             .select(F.lit(3).alias("part"), F.col("rank").alias("pos"),
                     F.format_string("  %s: %s (consistency=%.0f%%, |log2FC|=%.2f)", "expected_direction",
                                     "gene_symbol", F.col("consistency") * 100, "median_abs_log2fc").alias("line")))
    return head.unionByName(top).unionByName(best).unionByName(named)
