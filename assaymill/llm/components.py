"""Connected components of a graph given as edges, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaymill import session

MAX_ROUNDS = 100


def _print(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge; the component is its smallest node. `edges` has long columns a, b.

    Each round is two aggregations and two equi-joins against one row per node, so a node with very many neighbours is
    summed map-side and its join partition can be split; no group is gathered. Rounds are cut by a checkpoint.
    """
    pairs = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = session.cut(pairs)
    before = _print(pairs)
    for _ in range(MAX_ROUNDS):
        if before[0] == 0:
            break
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        pairs = session.cut(small.select("e.*").where(F.col("a") != F.col("b")).distinct())
        after = _print(pairs)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    roots = pairs.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
