"""Matrices, normalisation and readout analysis."""

from __future__ import annotations

from pyspark.sql import functions as F

from assaymill import dims
from assaymill.operators import backfill, normalize, readout
from assaymill.operators import expression as E
from assaymill.plans import adapters as A
from assaymill.plans.registry import query
from assaymill.session import cut

SHOWN = list(dims.PANEL)

BEST = ("best AS (SELECT * FROM (SELECT *, COALESCE(CAST(protocol_id AS VARCHAR), 'paper_' || paper_id) AS protocol_key, "
        "ROW_NUMBER() OVER (PARTITION BY COALESCE(CAST(protocol_id AS VARCHAR), 'paper_' || paper_id), gene "
        "ORDER BY COALESCE(confidence, 0) DESC, id) AS rn FROM ev WHERE gene <> 'GAPDH') q WHERE rn = 1)")


def rounded(df, *columns, places=6):
    for c in columns:
        df = df.withColumn(c, F.round(c, places))
    return df


@query("best_value_per_protocol_gene", A.sql(
    "SELECT protocol_key, gene AS gene_symbol, id, value, confidence, source_type, source_detail FROM best",
    A.EV, BEST))
def best_value_per_protocol_gene(spark, sf):
    return E.best_values(A.values(spark, sf)).select(
        "protocol_key", "gene_symbol", "id", "value", "confidence", "source_type", "source_detail")


@query("best_value_shared_ids", A.sql(
    "SELECT protocol_key, gene AS gene_symbol, id, value FROM (SELECT *, CAST(COALESCE(protocol_id, paper_id) AS VARCHAR) "
    "AS protocol_key, ROW_NUMBER() OVER (PARTITION BY COALESCE(protocol_id, paper_id), gene ORDER BY confidence DESC, id) "
    "AS rn FROM ev WHERE gene <> 'GAPDH') q WHERE rn = 1", A.EV))
def best_value_shared_ids(spark, sf):
    return E.best_values(A.values(spark, sf), parity=True).select("protocol_key", "gene_symbol", "id", "value")


def _pivot(value="value"):
    return ", ".join(f"MAX(CASE WHEN gene = '{g}' THEN {value} END) AS \"{g}\"" for g in SHOWN)


@query("expression_matrix_wide", A.sql(
    f"SELECT w.*, pa.pmc_id, pr.protocol_arm FROM (SELECT protocol_key, MAX(protocol_id) AS protocol_id, "
    f"MAX(paper_id) AS paper_id, {_pivot()} FROM best GROUP BY protocol_key) w JOIN pa ON pa.id = w.paper_id "
    f"LEFT JOIN pr ON pr.id = w.protocol_id", A.EV, BEST, A.PA, A.PR))
def expression_matrix_wide(spark, sf):
    return E.protocol_matrix(A.values(spark, sf), A.papers(spark, sf), A.protocols(spark, sf), SHOWN)


def _best_long(spark, sf):
    return E.best_values(A.values(spark, sf)).select("protocol_key", "paper_id", "gene_symbol", "value")


@query("rank_pct_norm", A.sql(
    "SELECT protocol_key, gene AS gene_symbol, value, ROUND(CASE WHEN value IS NOT NULL THEN "
    "(RANK() OVER (PARTITION BY paper_id, gene ORDER BY value NULLS LAST) "
    "+ (COUNT(*) OVER (PARTITION BY paper_id, gene, value) - 1) / 2.0) / COUNT(value) OVER (PARTITION BY paper_id, gene) "
    "END, 6) AS norm FROM best", A.EV, BEST))
def rank_pct_norm(spark, sf):
    n = normalize.normalize_across_studies(_best_long(spark, sf), "rank", ["protocol_key"], ["paper_id"])
    return rounded(n.select("protocol_key", "gene_symbol", "value", "norm"), "norm")


@query("relative_norm", A.sql(
    "SELECT protocol_key, gene AS gene_symbol, value, ROUND(value / NULLIF(MAX(value) OVER (PARTITION BY paper_id, gene), 0), 6) "
    "AS norm FROM best", A.EV, BEST))
def relative_norm(spark, sf):
    n = normalize.normalize_across_studies(_best_long(spark, sf), "within_study_relative", ["protocol_key"], ["paper_id"])
    return rounded(n.select("protocol_key", "gene_symbol", "value", "norm"), "norm")


@query("quantile_norm", A.sql(
    "SELECT r.protocol_key, r.gene AS gene_symbol, r.value, ROUND(m.norm, 6) AS norm FROM ranked r LEFT JOIN means m "
    "ON r.value IS NOT NULL AND m.pos = CAST(FLOOR(r.avg_rank) AS BIGINT)",
    A.EV, BEST,
    "ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY gene ORDER BY value NULLS LAST) AS pos, "
    "RANK() OVER (PARTITION BY gene ORDER BY value NULLS LAST) + (COUNT(*) OVER (PARTITION BY gene, value) - 1) / 2.0 "
    "AS avg_rank FROM best)",
    "means AS (SELECT pos, AVG(value) AS norm FROM ranked WHERE value IS NOT NULL GROUP BY pos)"))
def quantile_norm(spark, sf):
    n = normalize.normalize_across_studies(_best_long(spark, sf), "quantile", ["protocol_key"], ["paper_id"])
    return rounded(n.select("protocol_key", "gene_symbol", "value", "norm"), "norm")


@query("min_gene_coverage", A.sql(
    "SELECT protocol_key, COUNT(value) AS gene_count FROM best GROUP BY protocol_key HAVING COUNT(value) >= 3",
    A.EV, BEST))
def min_gene_coverage(spark, sf):
    return E.min_gene_coverage(E.best_values(A.values(spark, sf)))


@query("gene_coverage", A.sql(
    "SELECT gene AS gene_symbol, COUNT(value) AS n_protocols FROM best GROUP BY gene", A.EV, BEST))
def gene_coverage(spark, sf):
    return E.gene_coverage(E.best_values(A.values(spark, sf)))


@query("category_coverage", A.sql(
    "SELECT CASE gene WHEN 'POU5F1' THEN 'pluripotency' WHEN 'SOX17' THEN 'definitive_endoderm' WHEN 'HNF4A' THEN "
    "'hepatic_progenitor' WHEN 'ALB' THEN 'mature_hepatocyte' ELSE 'mesenchymal' END AS category, "
    "COUNT(DISTINCT protocol_key) AS n_protocols FROM best WHERE value IS NOT NULL GROUP BY 1", A.EV, BEST))
def category_coverage(spark, sf):
    return E.category_coverage(E.best_values(A.values(spark, sf)))


@query("provenance_map", A.sql(
    "SELECT protocol_key || '_' || gene AS key, source_type, source_detail, confidence, unit, value FROM best",
    A.EV, BEST))
def provenance_map(spark, sf):
    return E.provenance(A.values(spark, sf))


AGG = ("agg AS (SELECT ev.protocol_id, pa.pmc_id, pa.doi, pr.protocol_arm, gene AS gene_symbol, time_point_day, unit, "
       "AVG(value) AS mean_value, COUNT(value) AS n_replicates, STDDEV_SAMP(value) AS std_value, "
       "MAX(confidence) AS confidence FROM ev JOIN pa ON pa.id = ev.paper_id JOIN pr ON pr.id = ev.protocol_id "
       "WHERE gene <> 'GAPDH' AND ev.protocol_id IS NOT NULL AND time_point_day IS NOT NULL AND doi IS NOT NULL "
       "AND protocol_arm IS NOT NULL GROUP BY ALL)")
TRAJ = ("pts AS (SELECT * FROM agg WHERE protocol_id IN (SELECT protocol_id FROM agg GROUP BY 1 "
        "HAVING COUNT(DISTINCT time_point_day) >= 2)), "
        "ends AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY protocol_id, gene_symbol ORDER BY time_point_day, unit) AS lo, "
        "ROW_NUMBER() OVER (PARTITION BY protocol_id, gene_symbol ORDER BY time_point_day DESC, unit DESC) AS hi, "
        "ROW_NUMBER() OVER (PARTITION BY protocol_id, gene_symbol ORDER BY mean_value DESC NULLS LAST, time_point_day) AS pk "
        "FROM pts), "
        "t0 AS (SELECT protocol_id, gene_symbol, MAX(CASE WHEN lo = 1 THEN pmc_id END) AS pmc_id, "
        "MAX(CASE WHEN lo = 1 THEN time_point_day END) AS first_day, MAX(CASE WHEN hi = 1 THEN time_point_day END) AS last_day, "
        "COUNT(*) AS n_timepoints, MAX(CASE WHEN lo = 1 THEN mean_value END) AS first_value, "
        "MAX(CASE WHEN hi = 1 THEN mean_value END) AS last_value, MAX(mean_value) AS max_value, MIN(mean_value) AS min_value, "
        "AVG(mean_value) AS avg_value, MAX(CASE WHEN pk = 1 THEN time_point_day END) AS peak_day FROM ends GROUP BY 1, 2 "
        "HAVING COUNT(*) >= 2 AND MAX(mean_value) IS NOT NULL), "
        "t1 AS (SELECT *, CASE WHEN first_value > 0 AND last_value > 0 THEN last_value / NULLIF(first_value, 0) "
        "WHEN first_value = 0 AND last_value > 0 THEN last_value WHEN first_value > 0 AND last_value = 0 THEN 1 / NULLIF(first_value, 0) "
        "ELSE 1 END AS fold_change, max_value - min_value AS dynamic_range, CASE gene_symbol WHEN 'POU5F1' THEN 'down' "
        "WHEN 'SOX17' THEN 'transient_up' WHEN 'VIM' THEN 'low' ELSE 'up' END AS expected_direction FROM t0), "
        "traj AS (SELECT *, LOG2(fold_change) AS log2fc, COALESCE(CASE expected_direction WHEN 'down' THEN LOG2(fold_change) < -0.5 "
        "WHEN 'up' THEN LOG2(fold_change) > 0.5 WHEN 'transient_up' THEN peak_day < last_day AND max_value > first_value * 1.5 "
        "ELSE max_value < avg_value * 2 END, FALSE) AS follows_expected FROM t1)")


def _agg(spark, sf):
    return readout.aggregate(A.values(spark, sf), A.papers(spark, sf), A.protocols(spark, sf))


@query("readout_aggregate", A.sql(
    "SELECT protocol_id, pmc_id, doi, protocol_arm, gene_symbol, time_point_day, unit, ROUND(mean_value, 6) AS mean_value, "
    "n_replicates, ROUND(std_value, 6) AS std_value, confidence FROM agg", A.EV, A.PA, A.PR, AGG))
def readout_aggregate(spark, sf):
    return rounded(_agg(spark, sf), "mean_value", "std_value")


@query("readout_trajectories", A.sql(
    "SELECT protocol_id, pmc_id, gene_symbol, first_day, last_day, n_timepoints, ROUND(first_value, 6) AS first_value, "
    "ROUND(last_value, 6) AS last_value, ROUND(max_value, 6) AS max_value, ROUND(min_value, 6) AS min_value, peak_day, "
    "ROUND(fold_change, 6) AS fold_change, ROUND(log2fc, 6) AS log2fc, ROUND(dynamic_range, 6) AS dynamic_range, "
    "expected_direction, follows_expected FROM traj", A.EV, A.PA, A.PR, AGG, TRAJ))
def readout_trajectories(spark, sf):
    t = readout.trajectories(_agg(spark, sf)).drop("unit")
    return rounded(t, "first_value", "last_value", "max_value", "min_value", "fold_change", "log2fc", "dynamic_range")


RANK = ("g AS (SELECT gene_symbol, COUNT(DISTINCT protocol_id) AS np, CAST(SUM(CAST(follows_expected AS INTEGER)) AS BIGINT) AS nf, "
        "MEDIAN(ABS(log2fc)) AS ml, AVG(ABS(log2fc)) AS al, MEDIAN(dynamic_range) AS mr, ANY_VALUE(expected_direction) AS d FROM traj GROUP BY 1), "
        "tot AS (SELECT gene_symbol, COUNT(DISTINCT protocol_id) AS nt FROM agg GROUP BY 1), "
        "sc AS (SELECT g.*, tot.nt, nf / CAST(np AS DOUBLE) * 0.30 * CASE d WHEN 'up' THEN 1.0 WHEN 'down' THEN 0.9 WHEN 'transient_up' "
        "THEN 0.95 ELSE 0.3 END + LEAST(ml / 5, 1.0) * 0.35 + LEAST(np / 20.0, 1.0) * 0.20 + LEAST(mr / 1000, 1.0) * 0.15 AS score "
        "FROM g JOIN tot USING (gene_symbol)), "
        "rk AS (SELECT *, ROW_NUMBER() OVER (ORDER BY score DESC, gene_symbol) AS rank FROM sc)")


@query("readout_ranking", A.sql(
    "SELECT CAST(rank AS INTEGER) AS rank, gene_symbol, CASE gene_symbol WHEN 'POU5F1' THEN 'pluripotency' WHEN 'SOX17' THEN "
    "'definitive_endoderm' WHEN 'HNF4A' THEN 'hepatic_progenitor' WHEN 'ALB' THEN 'mature_hepatocyte' ELSE 'mesenchymal' END "
    "AS category, d AS expected_direction, np AS n_protocols_temporal, nt AS n_protocols_total, "
    "ROUND(nf / CAST(np AS DOUBLE), 6) AS consistency, nf AS n_follow_expected, ROUND(ml, 6) AS median_abs_log2fc, "
    "ROUND(al, 6) AS mean_abs_log2fc, ROUND(mr, 6) AS median_dynamic_range, ROUND(score, 6) AS composite_score FROM rk",
    A.EV, A.PA, A.PR, AGG, TRAJ, RANK))
def readout_ranking(spark, sf):
    agg = cut(_agg(spark, sf))
    r = readout.rank_readouts(readout.trajectories(agg), agg)
    return rounded(r, "consistency", "median_abs_log2fc", "mean_abs_log2fc", "median_dynamic_range", "composite_score")


TIMEPOINTS = ("ds AS (SELECT gene_symbol, time_point_day AS day, AVG(mean_value) AS mean_value, STDDEV_SAMP(mean_value) AS std_value, "
              "COUNT(DISTINCT protocol_id) AS n_protocols, CASE gene_symbol WHEN 'POU5F1' THEN 'down' WHEN 'SOX17' THEN 'transient_up' "
              "WHEN 'VIM' THEN 'low' ELSE 'up' END AS expected_direction FROM agg WHERE gene_symbol IN (SELECT gene_symbol FROM traj) "
              "GROUP BY 1, 2 HAVING COUNT(DISTINCT protocol_id) >= 2)")


@query("readout_timepoints", A.sql(
    "SELECT gene_symbol, expected_direction, day, ROUND(mean_value, 6) AS mean_value, ROUND(std_value, 6) AS std_value, "
    "ROUND(std_value / NULLIF(mean_value, 0), 6) AS cv, n_protocols, ROW_NUMBER() OVER (PARTITION BY gene_symbol ORDER BY "
    "CASE expected_direction WHEN 'down' THEN mean_value WHEN 'low' THEN -n_protocols ELSE -mean_value END NULLS LAST, day) = 1 "
    "AS is_optimal_day FROM ds", A.EV, A.PA, A.PR, AGG, TRAJ, TIMEPOINTS))
def readout_timepoints(spark, sf):
    agg = _agg(spark, sf)
    return rounded(readout.timepoints(readout.trajectories(agg), agg), "mean_value", "std_value", "cv")


@query("heatmap_norm", A.sql(
    "SELECT CAST(rk.rank AS INTEGER) AS rank, m.gene_symbol, m.day, ROUND(m.mv, 6) AS mean_value, "
    "ROUND(m.mv / NULLIF(MAX(m.mv) OVER (PARTITION BY m.gene_symbol), 0), 6) AS relative FROM (SELECT gene_symbol, "
    "time_point_day AS day, AVG(mean_value) AS mv FROM agg GROUP BY 1, 2) m "
    "JOIN rk USING (gene_symbol)", A.EV, A.PA, A.PR, AGG, TRAJ, RANK))
def heatmap_norm(spark, sf):
    agg = cut(_agg(spark, sf))
    ranked = readout.rank_readouts(readout.trajectories(agg), agg)
    return rounded(readout.heatmap(agg, ranked), "mean_value", "relative")


@query("within_protocol_norm", A.sql(
    "SELECT gene_symbol, time_point_day, ROUND(AVG(n), 6) AS mean_norm, ROUND(STDDEV_SAMP(n), 6) AS std_norm FROM (SELECT *, "
    "CASE WHEN MAX(mv) OVER (PARTITION BY gene_symbol, protocol_id) > 0 THEN mv / MAX(mv) OVER (PARTITION BY gene_symbol, protocol_id) "
    "ELSE 0 END AS n FROM (SELECT gene_symbol, protocol_id, time_point_day, AVG(mean_value) AS mv FROM agg WHERE protocol_id IN (SELECT protocol_id FROM agg GROUP BY 1 HAVING "
    "COUNT(DISTINCT time_point_day) >= 3) GROUP BY 1, 2, 3) q) q GROUP BY 1, 2",
    A.EV, A.PA, A.PR, AGG))
def within_protocol_norm(spark, sf):
    return rounded(readout.within_protocol_profile(_agg(spark, sf)), "mean_norm", "std_norm")


SUMMARY = ("cats AS (SELECT rk.*, CASE gene_symbol WHEN 'POU5F1' THEN 'pluripotency' WHEN 'SOX17' THEN 'definitive_endoderm' WHEN 'HNF4A' THEN "
           "'hepatic_progenitor' WHEN 'ALB' THEN 'mature_hepatocyte' ELSE 'mesenchymal' END AS category FROM rk), "
           "hd AS (SELECT COUNT(*) AS n, COUNT(DISTINCT protocol_id) AS p, COUNT(DISTINCT gene_symbol) AS g FROM agg)")


@query("readout_summary", A.sql(
    "SELECT 0 AS part, CAST(pos AS INTEGER) AS pos, line FROM (SELECT 0 AS pos, 'Total aggregated measurements: ' || format('{:,}', n) AS line FROM hd "
    "UNION ALL SELECT 1, 'Protocols with expression data: ' || p FROM hd UNION ALL SELECT 2, 'Genes in panel: ' || g FROM hd "
    "UNION ALL SELECT 3, 'Protocols with temporal (multi-day) data: ' || p FROM hd) q UNION ALL "
    "SELECT 1, CAST(rank AS INTEGER), '  ' || rank || ' ' || gene_symbol || ' ' || category || ' ' || np FROM cats WHERE rank <= 10 UNION ALL "
    "SELECT 2, 0, '  ' || gene_symbol || ' day ' || day || ' ' || n_protocols FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY gene_symbol ORDER BY "
    "CASE expected_direction WHEN 'down' THEN mean_value WHEN 'low' THEN -n_protocols ELSE -mean_value END NULLS LAST, day) AS rn FROM ds) q WHERE rn = 1 UNION ALL "
    "SELECT 3, CAST(rank AS INTEGER), '  ' || d || ': ' || gene_symbol FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY d ORDER BY rank) AS k FROM cats) q "
    "WHERE (d = 'up' AND k <= 5) OR (d IN ('down', 'transient_up') AND k <= 3)",
    A.EV, A.PA, A.PR, AGG, TRAJ, RANK, TIMEPOINTS, SUMMARY))
def readout_summary(spark, sf):
    """The lines of the summary; their rounded figures, which other queries check, are left out."""
    tables = readout.analyze(A.values(spark, sf), A.papers(spark, sf), A.protocols(spark, sf))
    plain = F.regexp_replace("line", r"^( *)(\d+)\. (\S+) +category=(\S+) .* n_protos=(\d+)$", "  $2 $3 $4 $5")
    plain = F.regexp_replace(plain, r"^  (\S+) +→ day +(\d+) .* n_protocols=(\d+)\)$", "  $1 day $2 $3")
    return tables["summary"].select("part", "pos", F.regexp_replace(plain, r" \(consistency=.*$", "").alias("line"))


@query("multi_day_protocols", A.sql(
    "SELECT protocol_id, COUNT(DISTINCT time_point_day) AS n_days FROM ev WHERE protocol_id IS NOT NULL AND "
    "time_point_day IS NOT NULL GROUP BY 1 HAVING COUNT(DISTINCT time_point_day) >= 2", A.EV))
def multi_day_protocols(spark, sf):
    return E.multi_day_protocols(A.values(spark, sf))


@query("trajectory_matrix", A.sql(
    "SELECT w.*, pa.pmc_id FROM (SELECT protocol_id, time_point_day, "
    + ", ".join(f"ROUND(AVG(CASE WHEN gene = '{g}' THEN value END), 6) AS \"{g}\"" for g in SHOWN)
    + " FROM ev WHERE gene <> 'GAPDH' AND time_point_day IS NOT NULL AND protocol_id IN (SELECT protocol_id FROM ev WHERE "
      "time_point_day IS NOT NULL AND protocol_id IS NOT NULL GROUP BY 1 HAVING COUNT(DISTINCT time_point_day) >= 2) "
      "GROUP BY 1, 2) w JOIN pa ON pa.id = w.protocol_id % 40", A.EV, A.PA))
def trajectory_matrix(spark, sf):
    return rounded(E.trajectory_matrix(A.values(spark, sf), A.papers(spark, sf), SHOWN), *SHOWN)


# -- backfills -------------------------------------------------------------------------------------------------

@query("backfill_comparison", A.sql(
    "SELECT id, CASE WHEN source_type = 'supplement_table' AND source_detail LIKE '%DEG%' THEN "
    "regexp_extract(source_detail, ': (.*)_vs_', 1) || ' vs D0' END AS comparison FROM ev", A.EV))
def backfill_comparison(spark, sf):
    return backfill.comparison(A.values(spark, sf)).select("id", "comparison")


@query("backfill_day_label", A.sql(
    "SELECT id, COALESCE(time_point_day, CAST(regexp_extract(condition_label, 'D([0-9]+)_', 1) AS INTEGER)) AS time_point_day "
    "FROM ev", A.EV))
def backfill_day_label(spark, sf):
    return backfill.day_from_label(A.values(spark, sf)).select("id", "time_point_day")


MAPS = ("m AS (SELECT user_id AS protocol_id, 'D' || " + A.DUCK_DAY + " || '_rep' || (event_id % 2) AS condition_label, "
        + A.DUCK_DAY + " + event_id % 3 AS time_point_day FROM events)")


@query("backfill_day_mapping", A.sql(
    "SELECT ev.id, COALESCE(ev.time_point_day, d.day) AS time_point_day FROM ev LEFT JOIN (SELECT protocol_id, "
    "condition_label, MIN(time_point_day) AS day FROM m GROUP BY 1, 2) d ON d.protocol_id = ev.protocol_id AND "
    "d.condition_label = ev.condition_label", A.EV, MAPS))
def backfill_day_mapping(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    maps = e.selectExpr("user_id AS protocol_id", f"'D' || {A.SPARK_DAY} || '_rep' || (event_id % 2) AS condition_label",
                        f"{A.SPARK_DAY} + event_id % 3 AS time_point_day")
    return backfill.day_from_mapping(A.values(spark, sf), maps).select("id", "time_point_day")


@query("day_coverage", A.sql(
    "SELECT COUNT(*) AS total, COUNT(time_point_day) AS has_day, ROUND(100.0 * COUNT(time_point_day) / COUNT(*), 6) AS percent "
    "FROM ev", A.EV))
def day_coverage(spark, sf):
    return rounded(backfill.day_coverage(A.values(spark, sf)), "percent")
