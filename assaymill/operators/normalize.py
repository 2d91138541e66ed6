"""Cross-study normalisation of long (row, group, gene, value) data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaymill.operators import ranking
from assaymill.operators.expression import widen


def rank_percentile(long: DataFrame, group: list[str], value: str = "value") -> DataFrame:
    """Average rank / number of present values within (group, gene); missing stays missing."""
    r = ranking.with_value_ranks(long, [*group, "gene_symbol"], value)
    norm = ranking.percent_rank_average(F.col("below"), F.col("ties"), F.col("n"))
    return r.withColumn("norm", norm).drop("below", "ties", "n")


def within_group_relative(long: DataFrame, group: list[str], value: str = "value") -> DataFrame:
    """Value over the maximum of its (group, gene); NULL where that maximum is 0."""
    keys = [*group, "gene_symbol"]
    top = long.groupBy(*keys).agg(F.nullif(F.max(value), F.lit(0.0)).alias("_top"))
    return (ranking.null_safe_join(long, top, keys, "left")
            .withColumn("norm", F.col(value) / F.col("_top")).drop("_top"))


def quantile(long: DataFrame, row_keys: list[str], value: str = "value") -> DataFrame:
    """Quantile normalisation across genes: the mean of the k-th smallest values replaces rank k.

    `row_keys` identify a matrix row, so that (row, gene) is unique. A run of equal values covers the sorted
    positions below+1 .. below+ties; positions are joined per gene run, never per pair of rows.
    """
    ranks = ranking.value_ranks(long, ["gene_symbol"], value)
    means = _positions(ranks, value).groupBy("pos").agg(F.avg(value).alias("norm"))
    pos = F.floor(F.col("below") + (F.col("ties") + 1) / F.lit(2.0)).alias("pos")
    lookup = (ranks.select("gene_symbol", value, pos).join(means, "pos").drop("pos"))
    return ranking.null_safe_join(long, lookup, ["gene_symbol", value], "left")


def _positions(ranks: DataFrame, value: str, piece: int = 10_000) -> DataFrame:
    """(pos, value) of every sorted position; a long run of equal values is cut up and spread over tasks."""
    first, last = F.col("below") + 1, F.col("below") + F.col("ties")
    short = ranks.where(F.col("ties") <= piece).select(F.explode(F.sequence(first, last)).alias("pos"), value)
    starts = ranks.where(F.col("ties") > piece).select(
        F.explode(F.sequence(first, last, F.lit(piece).cast("bigint"))).alias("_from"), last.alias("_to"), value)
    cut_up = starts.repartition("_from", value).select(
        F.explode(F.sequence(F.col("_from"), F.least(F.col("_from") + piece - 1, F.col("_to")))).alias("pos"), value)
    return short.unionByName(cut_up)


def normalize_across_studies(long: DataFrame, method: str, row_keys: list[str], group: list[str]) -> DataFrame:
    """Dispatch by method name; an unknown one leaves the data as it is, with an empty norm."""
    if method == "rank":
        return rank_percentile(long, group)
    if method == "within_study_relative":
        return within_group_relative(long, group)
    if method == "quantile":
        return quantile(long, row_keys)
    return long.withColumn("norm", F.lit(None).cast("double"))


def widen_both(long: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Wide matrix with `<gene>` and `<gene>_norm` columns."""
    both = []
    for g in columns:
        hit = F.col("gene_symbol") == g
        both += [F.max(F.when(hit, F.col("value"))).alias(g), F.max(F.when(hit, F.col("norm"))).alias(f"{g}_norm")]
    return long.groupBy(*keys).agg(*both)


__all__ = ["rank_percentile", "within_group_relative", "quantile", "normalize_across_studies", "widen", "widen_both"]
