"""A quality classifier by importance resampling: hashed n-gram models of target and raw text, sampled by Gumbel top-k.

Words and word pairs of a text (lower-cased A-Z; runs of punctuation are words too) are hashed to `buckets` buckets. Two generative
models are counted: raw text over all documents, target text over documents that the labels call good. A document's importance
weight is the log ratio of the target's to the raw model's probability of its n-grams, divided by the root of their number (so that
the noise of many n-grams does not grow with a text's length). Gumbel noise of a hash of the id is added and the `k` largest keys are
selected, which samples k documents without replacement in proportion to their weights.

The good documents are at most `max_target` labelled ids, lowest hash first (a documented sample for the fit, broadcast as ids);
all counts run over every document's whole text. The k-th largest key is found exactly by counting keys in ever narrower bins.

Null and empty texts have weight 0. Rows with equal keys (repeated rows among them) are selected together. A null id is not
labelled. Without labels both models are equal and every weight is 0. Extra columns are kept, those named like an output
column are replaced.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaymill import session
from assaymill.llm import arrowtext, sampling

BUCKETS = 1 << 18
MAX_TARGET = 200_000
#: Pseudo-count that both models give a bucket, so that rare n-grams weigh little.
PRIOR = 5.0
#: Scale of the weights against the noise.
SHARPNESS = 2.0
BINS = 4096
FEW = 1000

ADDED = ["n_grams", "log_weight", "gumbel_key", "selected"]


def features(buf: np.ndarray, offs: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, row) of every word and word pair of a chunk."""
    words = arrowtext.Words(buf, offs, arrowtext.WORD_OR_MARK)
    h = words.hashes()
    pairs = arrowtext.windows(h, 2)
    same = words.row[:-1] == words.row[1:] if len(h) > 1 else np.zeros(0, bool)
    every = np.concatenate([h, pairs[same]])
    return (every % np.uint64(buckets)).astype(np.int64), np.concatenate([words.row, words.row[:-1][same] if len(h) > 1 else words.row[:0]])


def models(docs: DataFrame, good: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """log(target / raw) of each bucket; `good` are sorted ids of target documents."""
    spark = docs.sparkSession
    arrowtext.bounded_batches(spark)
    shared = spark.sparkContext.broadcast(good)

    def run(batches):
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for part in arrowtext.chunks(batches):
            bucket, row = features(*arrowtext.byte_view(part.column("text")), buckets)
            ids = part.column("doc_id")
            chosen = np.isin(ids.fill_null(0).to_numpy(zero_copy_only=False), shared.value) & ids.is_valid().to_numpy(zero_copy_only=False)
            raw += np.bincount(bucket, minlength=buckets)
            target += np.bincount(bucket[chosen[row]], minlength=buckets)
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw[some]), pa.array(target[some])], ["bucket", "raw", "target"])

    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "bucket long, raw long, target long")
    rows = counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()  # `buckets` rows at most
    raw, target = np.zeros(buckets), np.zeros(buckets)
    at = rows["bucket"].to_numpy()
    raw[at], target[at] = rows["raw"].to_numpy(), rows["target"].to_numpy()
    return np.log((target + PRIOR) / (raw * (target.sum() / max(1, raw.sum())) + PRIOR))


def good_ids(labels: DataFrame, most: int = MAX_TARGET) -> tuple[np.ndarray, float]:
    """(sorted ids of good documents, share of labelled documents that are good); a repeated id is good if all its rows are."""
    one = (labels.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), (
        (F.coalesce("quality", F.lit(0)) == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).alias("good")).groupBy("doc_id").agg(F.min("good").alias("good")))
    share = one.agg(F.avg(F.col("good").cast("double"))).first()[0]
    ids = sampling.by_hash(one.where("good").select("doc_id"), most)["doc_id"].to_numpy()
    return np.sort(ids), 1.0 if share is None else share


def weigh(docs: DataFrame, ratio: np.ndarray, keep_text: bool = True) -> DataFrame:
    """`docs` with n_grams and log_weight."""
    spark = docs.sparkSession
    arrowtext.bounded_batches(spark)
    shared = spark.sparkContext.broadcast(ratio)
    kept = [f for f in docs.schema.fields if f.name not in ADDED and (keep_text or f.name != "text")]

    def run(batches):
        for part in arrowtext.chunks(batches):
            buf, offs = arrowtext.byte_view(part.column("text"))
            bucket, row = features(buf, offs, len(shared.value))
            n = np.bincount(row, minlength=len(offs) - 1)
            total = np.bincount(row, weights=shared.value[bucket], minlength=len(offs) - 1)
            weight = SHARPNESS * total / np.sqrt(np.maximum(n, 1))
            yield pa.RecordBatch.from_arrays([*[part.column(f.name) for f in kept], pa.array(n.astype(np.int64)), pa.array(weight)],
                                             [*[f.name for f in kept], "n_grams", "log_weight"])

    return docs.mapInArrow(run, T.StructType([*kept, T.StructField("n_grams", T.LongType()), T.StructField("log_weight", T.DoubleType())]))


def kth_largest(df: DataFrame, column: str, k: int) -> float | None:
    """The exact k-th largest value of a column without nulls; a bounded number of rows is gathered at each step."""
    low, high, n = df.agg(F.min(column), F.max(column), F.count(column)).first()
    if n == 0 or k < 1:
        return None
    k = min(k, n)
    while low < high:
        inside = df.where((F.col(column) >= low) & (F.col(column) <= high))
        if n <= FEW:
            return sorted((r[0] for r in inside.select(column).collect()), reverse=True)[k - 1]
        bin_of = F.least(F.floor((F.col(column) - low) / (high - low) * BINS), F.lit(BINS - 1))
        rows = inside.groupBy(bin_of.alias("bin")).agg(F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).collect()
        for r in sorted(rows, key=lambda r: -r["bin"]):
            if k <= r["n"]:
                low, high, n = r["low"], r["high"], r["n"]
                break
            k -= r["n"]
    return low


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None, seed: int = 7, buckets: int = BUCKETS,
             max_target: int = MAX_TARGET) -> DataFrame:
    """`docs` without their text, with the ADDED columns; `share` of all documents is selected (default: the labels' good share)."""
    good, labelled = good_ids(labels, max_target)
    ratio = models(docs, good, buckets) if len(good) else np.zeros(buckets)
    weighed = weigh(docs, ratio, keep_text=False)
    uniform = (F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    keyed = session.cut(weighed.withColumn("gumbel_key", F.col("log_weight") - F.log(-F.log(uniform))))
    k = math.ceil((labelled if share is None else share) * keyed.count())
    least = kth_largest(keyed, "gumbel_key", k)
    return keyed.withColumn("selected", F.lit(False) if least is None else F.col("gumbel_key") >= least)
