"""Audit of extracted protocols: stratified samples and rating summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaymill import dims
from assaymill.functions.genes import literal_map
from assaymill.operators.ranking import top_per_group


def confidence_bucket(confidence: Column) -> Column:
    """Half-open buckets; a missing confidence counts as 0."""
    c = F.coalesce(confidence, F.lit(0.0))
    return F.coalesce(*[F.when((c >= lo) & (c < hi), F.lit(name)) for name, lo, hi in dims.CONFIDENCE_BUCKETS],
                      F.lit("low"))


def stratified_sample(protocols: DataFrame, papers: DataFrame, per_bucket: int = 5, seed: int = 0,
                      order: Column | None = None) -> DataFrame:
    """Up to `per_bucket` protocols per (category, bucket), picked by a seeded hash of the id.

    There are only a few strata, each of them large: they are thinned in salted pieces first.
    """
    kinds = dims.EXTRACTABLE + [dims.REVIEW]
    p = papers.where(F.col("triage_category").isin(kinds)).select(
        F.col("id").alias("paper_id"), "pmc_id", "triage_category")
    j = protocols.join(p, "paper_id").withColumn("bucket", confidence_bucket(F.col("extraction_confidence")))
    pick = order if order is not None else F.xxhash64("id", F.lit(seed))
    return top_per_group(j.withColumn("_pick", pick), ["triage_category", "bucket"], ["_pick", "id"], per_bucket,
                         ["id"]).drop("_pick")


def rating_score(rating: Column) -> Column:
    return F.coalesce(F.try_element_at(literal_map(dims.RATING_SCORE), rating), F.lit(0.0))


def summary(results: DataFrame, min_rated: int = 5) -> DataFrame:
    """(section, key, value, n): overall, by bucket, by category, ratings, and confidence by rating.

    All five come from one pass: ratings collapse to (bucket, category, rating) cells, and the cells add up.
    """
    cells = results.groupBy(
        confidence_bucket(F.col("extraction_confidence")).alias("bucket"),
        F.coalesce("triage_category", F.lit("unknown")).alias("category"), "rating").agg(
            F.count(F.lit(1)).alias("c"), F.sum(F.coalesce("extraction_confidence", F.lit(0.0))).alias("conf"))
    rated = cells.where(F.col("rating") != "skip").withColumn("score", rating_score(F.col("rating")) * F.col("c"))

    def part(df, section, key, value):
        return df.select(F.lit(section).alias("section"), key.alias("key"), value.alias("value"), F.col("n"))

    mean = F.sum("score") / F.sum("c")
    overall = part(rated.agg(mean.alias("v"), F.sum("c").alias("n")).where("n > 0"),
                   "overall", F.lit("all"), F.col("v"))
    frames = [overall]
    for section, column in (("bucket", "bucket"), ("category", "category")):
        frames.append(part(rated.groupBy(column).agg(mean.alias("v"), F.sum("c").alias("n")),
                           section, F.col(column), F.col("v")))
    frames.append(part(cells.groupBy("rating").agg(F.sum("c").alias("n")), "rating", F.col("rating"),
                       F.lit(None).cast("double")))
    # One row per rating, five at most.
    by_rating = rated.groupBy("rating").agg((F.sum("conf") / F.sum("c")).alias("v"), F.sum("c").alias("n"))
    by_rating = by_rating.withColumn("_rated", F.sum("n").over(Window.partitionBy(F.lit(0)))).where(
        F.col("_rated") >= min_rated)
    frames.append(part(by_rating, "confidence", F.col("rating"), F.col("v")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
