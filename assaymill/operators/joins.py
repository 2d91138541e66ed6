"""Joins that stay even when many rows have no key, and substring matching by an inverted index."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

SALTS = 1024


def left_lookup(left: DataFrame, right: DataFrame, on: list[str], spread_on: list[str] | None = None) -> DataFrame:
    """Left join on keys that may be missing.

    Rows without a key match nothing but would all be shuffled to one task; a salt taken from their other
    columns spreads them. `right` has one row per key.
    """
    others = spread_on or [f.name for f in left.schema.fields if isinstance(f.dataType, AtomicType) and f.name not in on][:4]
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in on])
    salt = F.when(missing, F.pmod(F.xxhash64(*others), F.lit(SALTS))).otherwise(F.lit(0)) if others else F.lit(0)
    salted = left.withColumn("_salt", salt.cast("bigint"))
    return salted.join(right.withColumn("_salt", F.lit(0).cast("bigint")), [*on, "_salt"], "left").drop("_salt")


#: Characters of an index entry. Shorter needles are looked up as they are.
GRAM = 3


def grams(text: Column, size: Column | int) -> Column:
    """All distinct runs of `size` characters of a text; none if it is shorter."""
    size = F.lit(size) if isinstance(size, int) else size
    starts = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - size + 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, size)))


def contained_in(outer: DataFrame, text: str, inner: DataFrame, needle: str) -> DataFrame:
    """Pairs where `needle` occurs in `text`, by an inverted index of the texts' character runs.

    A needle is looked up by its rarest run among the texts; one with a run that no text has is dropped. Candidates are then verified.
    Index entries grow with the length of the texts, not with its square, and needles without a match cost no candidate.
    """
    sizes = [r["n"] for r in inner.select(F.least(F.length(needle), F.lit(GRAM)).alias("n")).where("n > 0").distinct().collect()]  # GRAM rows at most
    if not sizes:
        sizes = [GRAM]
    index = outer.withColumn("_gram", F.explode(F.flatten(F.array(*[grams(F.col(text), n) for n in sizes]))))
    known = index.groupBy("_gram").agg(F.count("*").alias("_texts"))
    own = inner.where(F.col(needle) != "").select(needle).distinct()
    parts = own.withColumn("_gram", F.explode(grams(F.col(needle), F.least(F.length(needle), F.lit(GRAM)))))
    rarest = parts.join(known, "_gram", "left").groupBy(needle).agg(
        F.min(F.struct(F.coalesce("_texts", F.lit(0).cast("bigint")).alias("n"), F.col("_gram").alias("g"))).alias("_r"))
    chosen = rarest.where("_r.n > 0").select(F.col(needle).alias("_needle"), F.col("_r.g").alias("_gram"))
    hits = index.join(chosen, "_gram").where(F.contains(F.col(text), F.col("_needle"))).drop("_gram")
    return hits.join(inner, hits["_needle"] == inner[needle]).drop("_needle")
