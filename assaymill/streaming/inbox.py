"""Append logs as streams: what is new is merged into a snapshot table, once, however often the job restarts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaymill.operators import upserts
from assaymill.sources import jsonl, snapshots


def triage_log(spark: SparkSession, folder: str, max_files: int = 1000) -> DataFrame:
    """Triage records arriving as JSON-lines files; malformed lines are dropped."""
    lines = spark.readStream.option("maxFilesPerTrigger", max_files).text(folder)
    r = lines.select(F.from_json(
        "value", jsonl.TRIAGE_LINE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}).alias("r"))
    return (r.select("r.*").where(F.col("_corrupt_record").isNull() & (F.coalesce("pmc_id", F.lit("")) != ""))
            .drop("_corrupt_record"))


def drain(stream: DataFrame, merge: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Process all that is available in batches, then stop; a restart goes on after the last merged batch."""
    stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start().awaitTermination()


def first_per_key(table: str, key: list[str], order: str | None = None) -> Callable[[DataFrame, int], None]:
    """Merge that keeps the first record per key, as an import does: the snapshot is its state, not memory.

    Inside a batch the first is that of the least `order` value, or the least record where a log has no order column.
    """
    def merge(batch: DataFrame, _: int) -> None:
        rest = [c for c in batch.columns if c not in key]
        whole = F.struct(*rest)
        first = F.min(whole) if order is None else F.min_by(whole, F.struct(order, whole))
        one = batch.groupBy(*key).agg(first.alias("x")).select(*key, "x.*")
        old = snapshots.latest(batch.sparkSession, table)
        snapshots.write_next(one if old is None else upserts.append_absent(old, one, key), table)
    return merge


def last_per_key(table: str, key: list[str], order: str) -> Callable[[DataFrame, int], None]:
    """Merge that keeps the last record per key by an order column, as a re-read status log does."""
    def merge(batch: DataFrame, _: int) -> None:
        old = snapshots.latest(batch.sparkSession, table)
        every = batch if old is None else old.unionByName(batch)
        rest = [c for c in every.columns if c not in key]
        latest = every.groupBy(*key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("x")).select(*key, "x.*")
        snapshots.write_next(latest, table)
    return merge
