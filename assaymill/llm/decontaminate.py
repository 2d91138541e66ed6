"""Benchmark decontamination: a broadcast hash set of the test items' word windows, scanned over all training windows.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the text with A-Z lower-cased. A window is 13 consecutive words of an item; an
item of fewer words, but not none, is one window of its own length. A scan hashes every window of every document (numpy over
whole Arrow chunks), looks the hashes up in the set and verifies each hit word by word.

The set is broadcast only while it holds at most `max_windows` windows (checked before it is gathered); a larger benchmark
is joined to the documents' windows by a shuffle. Both give the same rows.

Null texts have no words. Items with a null id still mark words, but are not counted or named. Repeated items count once by
id. Rows are judged one by one, so repeated documents get equal results; extra columns are kept, those named like an output
column are replaced.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaymill.llm import arrowtext

WINDOW = 13
#: Windows in a broadcast set, at some 200 bytes each. A benchmark with more is joined instead.
MAX_WINDOWS = 200_000
#: A document is contaminated if at least one in this many of its words is hit.
HIT_SHARE = 20

ADDED = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def words_of(text: bytes | None) -> list[bytes]:
    if not text:
        return []
    buf = np.frombuffer(text, np.uint8)
    w = arrowtext.Words(buf, np.array([0, len(buf)]))
    return [w.word(i) for i in range(len(w.start))]


def item_windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """Distinct (item_id as string, n, window) of the benchmark; a window's words are joined by one blank."""
    arrowtext.bounded_batches(items.sparkSession)

    def run(batches):
        for part in batches:
            rows = []
            for item, text in zip(part.column("item_id").to_pylist(), arrowtext.plain(part.column("text")).to_pylist(), strict=True):
                words = words_of(text)
                n = min(size, len(words))
                rows += [(item, n, b" ".join(words[i:i + n])) for i in range(len(words) - n + 1) if n]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32()),
                                              pa.array([r[2] for r in rows], pa.binary())], ["item_id", "n", "window"])

    source = items.select(F.col("item_id").cast("string").alias("item_id"), "text")
    return source.mapInArrow(run, "item_id string, n int, window binary").distinct()


class WindowSet:
    """The hash set of the windows: hashes by length for the scan, items by window for the verification."""

    def __init__(self, rows):
        self.items: dict[bytes, set[str]] = {}
        by_length: dict[int, set[bytes]] = {}
        for item, n, window in rows:
            window = bytes(window)
            held = self.items.setdefault(window, set())
            if item is not None:
                held.add(item)
            by_length.setdefault(n, set()).add(window)
        self.hashes = {n: self._hashes(sorted(w), n) for n, w in by_length.items()}

    @staticmethod
    def _hashes(found: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
        data = b"\0".join(found) + b"\0"
        buf = np.frombuffer(data, np.uint8)
        h = arrowtext.windows(arrowtext.Words(buf, np.array([0, len(buf)])).hashes(), n)[::n]
        h = np.unique(h)
        seen = np.zeros(1 << 20, bool)
        seen[(h >> np.uint64(44)).astype(np.int64)] = True
        return h, seen

    def find(self, words: arrowtext.Words):
        """(first word, number of words, items) of each verified occurrence, in no order."""
        h = words.hashes()
        for n, (known, seen) in self.hashes.items():
            w = arrowtext.windows(h, n)
            maybe = np.flatnonzero(seen[(w >> np.uint64(44)).astype(np.int64)])
            maybe = maybe[words.row[maybe] == words.row[maybe + n - 1]]
            for i in maybe[np.isin(w[maybe], known)].tolist():
                items = self.items.get(b" ".join(words.word(k) for k in range(i, i + n)))
                if items is not None:
                    yield i, n, items


def scan(words: arrowtext.Words, known: WindowSet) -> tuple[np.ndarray, list[set[str]], np.ndarray]:
    """For a chunk: hit words by row, items by row, and the flag of each word."""
    step = np.zeros(len(words.start) + 1, np.int64)
    items: list[set[str]] = [set() for _ in range(words.n_rows)]
    for i, n, found in known.find(words):
        step[i] += 1
        step[i + n] -= 1
        items[words.row[i]] |= found
    hit = np.cumsum(step[:-1]) > 0
    return np.bincount(words.row[hit], minlength=words.n_rows).astype(np.int64), items, hit


def _cut(text: bytes, words: arrowtext.Words, hit: np.ndarray, first: int, last: int, base: int) -> bytes:
    """The text without its runs of hit words."""
    kept, at = [], 0
    flags = hit[first:last]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    for a, b in zip(edges[::2], edges[1::2], strict=True):
        kept.append(text[at:words.start[first + a] - base])
        at = words.end[first + b - 1] - base
    return b"".join([*kept, text[at:]])


def annotate(docs: DataFrame, items: DataFrame, size: int = WINDOW, max_windows: int = MAX_WINDOWS, share: int = HIT_SHARE,
             keep_text: bool = True, cut_spans: bool = False) -> DataFrame:
    """`docs` with ADDED columns; with cut_spans also `clean_text`, the text without the hit spans (broadcast sets only)."""
    found = item_windows(items, size)
    rows = found.limit(max_windows + 1).collect()
    if len(rows) > max_windows:
        if cut_spans:
            raise ValueError("a benchmark too large to broadcast marks documents, not spans")
        return _joined(docs, found, size, share, keep_text)
    spark = docs.sparkSession
    arrowtext.bounded_batches(spark)
    known = spark.sparkContext.broadcast([tuple(r) for r in rows])
    kept = [f for f in docs.schema.fields if f.name not in [*ADDED, "clean_text"] and (keep_text or f.name != "text")]
    names = [f.name for f in kept]
    fields = kept + [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("n_items", T.LongType()),
                     T.StructField("items_sha256", T.StringType()), T.StructField("contaminated", T.BooleanType())]
    fields += [T.StructField("clean_text", T.StringType())] if cut_spans else []

    def run(batches):
        windows = WindowSet(known.value)
        for part in arrowtext.chunks(batches):
            buf, offs = arrowtext.byte_view(part.column("text"))
            words = arrowtext.Words(buf, offs)
            n_words = words.counts()
            n_hit, found, hit = scan(words, windows)
            sha = [hashlib.sha256(",".join(sorted(f)).encode()).hexdigest() if f else NO_ITEMS for f in found]
            out = [part.column(c) for c in names]
            out += [pa.array(n_words), pa.array(n_hit), pa.array([len(f) for f in found], pa.int64()), pa.array(sha, pa.string()),
                    pa.array((n_hit > 0) & (share * n_hit >= n_words))]
            if cut_spans:
                ends, raw = np.concatenate([[0], np.cumsum(n_words)]), part.column("text").cast(pa.large_binary()).to_pylist()
                out.append(pa.array([t if t is None or not n_hit[i] else _cut(t, words, hit, ends[i], ends[i + 1], offs[i])
                                     for i, t in enumerate(raw)], pa.large_binary()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays(out, [f.name for f in fields])

    return docs.mapInArrow(run, T.StructType(fields))


NO_ITEMS = hashlib.sha256(b"").hexdigest()


def _joined(docs: DataFrame, found: DataFrame, size: int, share: int, keep_text: bool) -> DataFrame:
    """The same by a shuffle of the documents' windows, for a benchmark of any size."""
    lengths = [r["n"] for r in found.select("n").distinct().collect()]  # at most `size` values
    keyed = docs.drop(*ADDED).withColumn("_row", F.xxhash64("doc_id", "text"))

    def run(batches):
        for part in arrowtext.chunks(batches):
            buf, offs = arrowtext.byte_view(part.column("text"))
            words, key = arrowtext.Words(buf, offs), part.column("_row").to_numpy(zero_copy_only=False)
            for n in lengths:
                start = np.arange(max(0, len(words.start) - n + 1))
                start = start[words.row[start] == words.row[start + n - 1]]
                first = np.cumsum(words.counts()) - words.counts()
                rows = words.row[start]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[rows]), pa.array((start - first[rows]).astype(np.int32)), pa.array(np.full(len(start), n, np.int32)),
                     pa.array([b" ".join(words.word(k) for k in range(i, i + n)) for i in start.tolist()], pa.binary())],
                    ["_row", "at", "n", "window"])

    count = F.size(F.split(F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
                           r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", -1)) - 1
    distinct = keyed.select("_row", "text").dropDuplicates(["_row"])
    hits = distinct.mapInArrow(run, "_row long, at int, n int, window binary").join(found, ["n", "window"])
    covered = hits.select("_row", F.explode(F.sequence("at", F.col("at") + F.col("n") - 1)).alias("place")).distinct()
    named = hits.where(F.col("item_id").isNotNull()).select("_row", "item_id").distinct()
    joined = (keyed.join(covered.groupBy("_row").agg(F.count("*").alias("n_hit")), "_row", "left")
              .join(named.groupBy("_row").agg(F.sort_array(F.collect_list("item_id")).alias("_items")), "_row", "left"))
    out = (joined.withColumn("n_words", count.cast("long")).withColumn("n_hit", F.coalesce("n_hit", F.lit(0).cast("long")))
           .withColumn("_items", F.coalesce("_items", F.array().cast("array<string>")))
           .withColumn("n_items", F.size("_items").cast("long")).withColumn("items_sha256", F.sha2(F.array_join("_items", ","), 256))
           .withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))))
    return out.select(*[c for c in keyed.columns if c != "_row" and (keep_text or c != "text")], *ADDED)
