"""Exact ranks, medians and running maxima that hold when one group has most of the rows.

A window partitioned by a hot key puts that key into one task. The operators here first
collapse equal values (partial aggregation), then cut every group into value ranges whose totals
are added up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaymill.session import cut

#: Value ranges per unit of the inverse hyperbolic sine, in which a group's values are cut.
RANGES = 256


def value_range(value: Column) -> Column:
    """The range of a number: a whole number that never falls as the value grows, NaN last."""
    x = value.cast("double")
    return F.when(F.isnan(x), F.lit((1 << 63) - 1)).otherwise(F.floor(F.asinh(x) * RANGES).cast("bigint"))


def value_ranks(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """One row per (keys, value): `below` smaller non-null rows, `ties` equal ones, `n` rows in the group.

    Equal values are summed map-side, then ranked inside ranges of the value; the totals of the ranges before are added.
    A range is a function of the value alone, so nothing is sampled or written for it and a group of any size is spread
    over some thousands of ranges.
    """
    counts = (df.where(F.col(value).isNotNull())
              .groupBy(*keys, value).agg(F.count(F.lit(1)).alias("ties")).withColumn("_part", value_range(F.col(value))))
    by_keys = [F.col(k) for k in keys] or [F.lit(0)]
    totals = counts.groupBy(*keys, "_part").agg(F.sum("ties").alias("_rows"))
    over_parts = Window.partitionBy(*by_keys).orderBy("_part")
    totals = totals.select(
        *keys, "_part",
        F.coalesce(F.sum("_rows").over(over_parts.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .alias("_offset"),
        F.sum("_rows").over(Window.partitionBy(*by_keys)).alias("n"))
    inside = (Window.partitionBy(*by_keys, "_part").orderBy(value)
              .rowsBetween(Window.unboundedPreceding, -1))
    ranged = counts.withColumn("_inside", F.coalesce(F.sum("ties").over(inside), F.lit(0)))
    joined = null_safe_join(ranged, totals, [*keys, "_part"])
    return joined.select(*keys, value, "ties", (F.col("_offset") + F.col("_inside")).alias("below"), "n")


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys where NULL equals NULL; the right side's keys are dropped."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    on = None
    for k in keys:
        one = left[k].eqNullSafe(renamed[f"_r_{k}"])
        on = one if on is None else on & one
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def with_value_ranks(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """`df` with `below`, `ties` and `n`; rows whose value is missing keep NULLs."""
    return null_safe_join(df, value_ranks(df, keys, value), [*keys, value], "left")


def percent_rank_average(below: Column, ties: Column, n: Column) -> Column:
    """Average rank over the number of present values."""
    return (below + (ties + 1) / F.lit(2.0)) / n


def grouped_median(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Exact median per group (mean of the middle two), by position instead of a buffer of all values."""
    r = value_ranks(df, keys, value)
    low, high = F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2)

    def covers(p):
        return (F.col("below") <= p) & (p < F.col("below") + F.col("ties"))

    return (r.where(covers(low) | covers(high)).groupBy(*keys)
            .agg(((F.max(F.when(covers(low), F.col(value))) + F.max(F.when(covers(high), F.col(value)))) / 2)
                 .alias(name)))


def numbered(df: DataFrame, order: list, name: str, start: int = 1) -> DataFrame:
    """Dense position of every row in a total order, without a one-task window.

    Rows are range-partitioned and sorted; partition sizes (one row per partition) give the offsets.
    """
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = cut(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()))
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    offsets = sizes.select(
        F.col("_part").alias("_p"),
        F.coalesce(F.sum("_rows").over(
            Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .alias("_offset"))
    inside = Window.partitionBy("_part").orderBy(*order)
    return (ranged.join(F.broadcast(offsets), F.col("_part") == F.col("_p"))
            .withColumn(name, F.col("_offset") + F.row_number().over(inside) + (start - 1))
            .drop("_part", "_p", "_offset"))


def record_breakers(df: DataFrame, keys: list[str], order: str, value: str, chunk: int = 100_000) -> DataFrame:
    """Rows whose value exceeds that of every earlier row of their group.

    A group is cut into chunks of the order column, a write position counted upwards; a row must beat its chunk
    so far and all chunks before.
    """
    cut_up = df.withColumn("_chunk", F.floor(F.col(order) / chunk))
    inside = (Window.partitionBy(*keys, "_chunk").orderBy(order)
              .rowsBetween(Window.unboundedPreceding, -1))
    local = cut_up.withColumn("_best", F.max(value).over(inside))
    local = local.where(F.col("_best").isNull() | (F.col(value) > F.col("_best")))
    tops = cut_up.groupBy(*keys, "_chunk").agg(F.max(value).alias("_top"))
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.withColumn("_before", F.max("_top").over(earlier)).drop("_top")
    joined = null_safe_join(local, tops, [*keys, "_chunk"])
    return (joined.where(F.col("_before").isNull() | (F.col(value) > F.col("_before")))
            .drop("_chunk", "_best", "_before"))


def top_per_group(df: DataFrame, keys: list[str], order: list, k: int, salt_on: list[str],
                  name: str | None = None, salts: int = 64) -> DataFrame:
    """First `k` rows per group. A hot group is first thinned in `salts` pieces, so no task sorts all of it.

    `name` adds the position; k is part of the operator's meaning (a preview, a sample, a budget).
    """
    piece = F.pmod(F.xxhash64(*salt_on), F.lit(salts))
    w = Window.partitionBy(*keys, "_salt").orderBy(*order)
    thin = df.withColumn("_salt", piece).withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)
    w = Window.partitionBy(*keys).orderBy(*order)
    out = thin.drop("_salt", "_rn").withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)
    return out.withColumnRenamed("_rn", name) if name else out.drop("_rn")
