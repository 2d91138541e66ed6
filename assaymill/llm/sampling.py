"""A bounded, repeatable sample of rows for fitting."""

from __future__ import annotations

import math

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 52


def by_hash(df: DataFrame, most: int) -> pa.Table:
    """At most `most` distinct rows, those of the lowest hashes of the whole row; all of them if there are no more.

    Rows are taken by a threshold on the hash that lets somewhat more than `most` pass, so that tasks send no more than
    that in all, and are then cut. Repeated rows are combined before they are sent.
    """
    columns = df.columns
    rows = df.withColumn("_hash", F.pmod(F.xxhash64(*columns), F.lit(1 << BITS)))
    n = df.agg(F.approx_count_distinct(F.xxhash64(*columns), 0.02)).first()[0]
    share = (most + 6 * math.sqrt(most) + 20) / max(1.0, 0.9 * n)
    if share < 1:
        rows = rows.where(F.col("_hash") < int(share * (1 << BITS)))
    found = rows.distinct().toArrow()
    order = pa.compute.sort_indices(found["_hash"])
    return found.take(order[:most]).drop_columns(["_hash"])
