"""Session settings and the two materialisation helpers the operators share."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"

# What a job should run with on a cluster; AQE splits skewed join partitions even
# where an aggregate downstream would reuse the partitioning.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(builder):
    """Apply SETTINGS to a SparkSession builder."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names. One process alone (`local`) may set a temporary one; a cluster must name its own."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError(f"{CHECKPOINT_CONF} is not set: it must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="assaymill-ckpt-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Materialise on reliable storage so that every reader sees the same rows and lineage stays short."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame, key: str, rows_per_task: int = 250_000) -> DataFrame:
    """Rows dealt to tasks by `key`, in as many tasks as their number asks for.

    A shuffle that is sized by its bytes gives a task more rows the better they compress; what a task then builds of each row outgrows it.
    """
    return df.repartition(max(1, -(-df.count() // rows_per_task)), key)


def few(df: DataFrame, most: int = 200_000) -> DataFrame:
    """The rows materialised, and broadcast to a join where they are counted to be few: then the other side is not shuffled by keys that few values share."""
    kept = cut(df)
    return F.broadcast(kept) if kept.count() <= most else kept


def settle(df: DataFrame) -> DataFrame:
    """Compute the columns here, once.

    A filter on a computed column is pushed below it by repeating its expression. Where that expression is
    a document parse, the repetition costs more than the rows it drops: a generator in between stops it.
    """
    return df.select(F.explode(F.array(F.struct(*df.columns))).alias("_row")).select("_row.*")
