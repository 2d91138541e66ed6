"""Ranked lexical search as an exact maximum inner product search with norm buckets.

A document is an impact vector over the terms of the query items: for a term of weight w, its impact is
(1000000000 * tf) div (1000 * tf + 8 * m), with m = 25 + (75 * n * N) div L. A score is the inner product of the impacts with w times the
item's own counts. For the bounds both sides are scaled by the root of w, which leaves products as they are.

Passes over the documents, for each block of items (a block's text is bounded, so its terms are):
1. counts: N, L and each term's document frequency, summed in tasks and by an aggregation.
2. vectors: scanned again with the counts, dealt out by norm bucket and salt, sorted by descending bucket inside each partition, and checkpointed.
3. lead: the longest vectors of every partition are scored; the k-th best score of an item over all of them is a lower bound of its result.
4. search: each partition goes down its buckets. A bucket slice is skipped for an item if the item's norm times the slice's largest norm
   (Cauchy-Schwarz) is below the item's bound; inside, the exact part of an item's heaviest coordinates plus the product of
   both remainders' norms bounds each vector; survivors are scored exactly in 64-bit integers. The bound rises as results come in.
   Bounds are doubles with a margin far above their rounding, and what equals a bound survives, so nothing of the result is lost.
Each partition sends its k best of an item on; those are thinned in salted pieces and ranked.

Terms are `[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+` with A-Z lower-cased, found by hash and compared byte by byte. Null texts have no terms.
Every item row is an item of its own, so repeated items give repeated rows; an item without terms or hits gives none. Equal scores
are ranked by doc_id, null last; repeated documents are ranked as they are. Very long texts are scanned in slices. Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaymill import session
from assaymill.llm import arrowtext
from assaymill.operators import ranking

TOP = 10
#: Characters of the items that one block holds on average; a block's terms and weights travel to every task.
BLOCK_CHARS = 2 << 20
#: Norms of a bucket differ by a factor of 2 ** (1 / BUCKETS) at most.
BUCKETS = 8
SALTS = 1 << 16
#: Vectors bounded and scored at once, and vectors of a partition that give the first bound.
SLICE = 2048
#: Coordinates of an item whose part of the product is exact in a vector's bound.
FOCUS = 6
MARGIN = 1 + 1e-9


class Terms:
    """The distinct terms of a block: hash, bytes and number of each."""

    def __init__(self, found: list[bytes]):
        self.found = found
        data = b"\0".join([*found, b""])
        words = arrowtext.Words(buf := np.frombuffer(data, np.uint8), np.array([0, len(buf)]))
        hashes = words.hashes()
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        if len(np.unique(hashes)) < len(found):
            raise ValueError("two terms of the items have one hash")
        self.low, self.start, self.size = words.low, words.start, words.end - words.start
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(self.hashes >> np.uint64(44)).astype(np.int64)] = True

    def match(self, words: arrowtext.Words) -> tuple[np.ndarray, np.ndarray]:
        """(word, term) of each word that is a term."""
        h = words.hashes()
        word = np.flatnonzero(self.seen[(h >> np.uint64(44)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.hashes, h[word]), len(self.hashes) - 1)
        term = self.order[at]
        size = words.end[word] - words.start[word]
        same = (self.hashes[at] == h[word]) & (self.size[term] == size)
        word, term, size = word[same], term[same], size[same]
        if not len(word):
            return word, term
        first = np.cumsum(size) - size
        within = np.arange(int(size.sum())) - np.repeat(first, size)
        equal = words.low[np.repeat(words.start[word], size) + within] == self.low[np.repeat(self.start[term], size) + within]
        same = np.logical_and.reduceat(equal, first)
        return word[same], term[same]


def slices(buf: np.ndarray, offs: np.ndarray, limit: int = arrowtext.CHUNK_BYTES):
    """The chunk as (bytes, offsets), or a longer text in parts that end between words."""
    if len(offs) != 2 or len(buf) <= limit:
        yield buf, offs
        return
    at = 0
    while at < len(buf):
        end = min(len(buf), at + limit)
        while end < len(buf):
            gap = np.flatnonzero(~arrowtext.WORD_BYTE[arrowtext.LOWER[buf[end:end + limit]]])
            if len(gap):
                end += int(gap[0])
                break
            end = min(len(buf), end + limit)
        yield buf[at:end], np.array([0, end - at])
        at = end


def counted(buf: np.ndarray, offs: np.ndarray, terms: Terms) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(n of each row, then row, term and tf of each term that a row holds, by row)."""
    n, keys, tf = np.zeros(len(offs) - 1, np.int64), [], []
    width = max(1, len(terms.found))
    for part, edges in slices(buf, offs):
        words = arrowtext.Words(part, edges)
        n += words.counts()
        word, term = terms.match(words)
        key, count = np.unique(words.row[word] * width + term, return_counts=True)
        keys.append(key), tf.append(count)
    key, count = keys[0], tf[0]
    if len(keys) > 1:
        key, at = np.unique(np.concatenate(keys), return_inverse=True)
        count = np.bincount(at, weights=np.concatenate(tf), minlength=len(key)).astype(np.int64)
    return n, key // width, key % width, count


class Block:
    """Query items with their terms; weights come with the counts of the documents."""

    def __init__(self, texts: list[str | None]):
        rows = []
        for text in texts:
            buf = np.frombuffer((text or "").encode(), np.uint8)
            words = arrowtext.Words(buf, np.array([0, len(buf)]))
            own: dict[bytes, int] = {}
            for i in range(len(words.start)):
                own[words.word(i)] = own.get(words.word(i), 0) + 1
            rows.append(own)
        found = sorted({t for own in rows for t in own})
        number = {t: i for i, t in enumerate(found)}
        self.terms = Terms(found)
        self.items = [(np.array([number[t] for t in own], np.int64), np.array(list(own.values()), np.int64)) for own in rows]

    def weigh(self, n_docs: int, n_terms: int, df: dict[int, int]) -> None:
        self.n_docs, self.n_terms = n_docs, n_terms
        self.w = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(self.terms.found))], np.int64)
        self.scale = np.sqrt(self.w.astype(float))


def blocks(items: DataFrame, chars: int = BLOCK_CHARS):
    """(item_ids, Block) of the items in blocks of about `chars` characters; one block at a time is held by the driver."""
    rows = session.cut(items.select("item_id", "text", F.monotonically_increasing_id().alias("_item")))
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, math.ceil(total / chars))
    for part in range(parts):
        held = rows.where(F.pmod(F.xxhash64("_item"), F.lit(parts)) == part).orderBy("_item").collect()
        block = Block([r["text"] for r in held])
        if block.terms.found:
            yield [r["item_id"] for r in held], block


def counts(docs: DataFrame, block: Block) -> tuple[int, int, dict[int, int]]:
    """N, L, and the document frequency of each of the block's terms: one row a term leaves a task, one a term reaches the driver."""
    held = docs.sparkSession.sparkContext.broadcast(block.terms)

    def run(batches):
        terms = held.value
        df, n_docs, n_terms = np.zeros(len(terms.found), np.int64), 0, 0
        for part in arrowtext.chunks(batches):
            n, _, term, _ = counted(*arrowtext.byte_view(part.column("text")), terms)
            df += np.bincount(term, minlength=len(df))
            n_docs, n_terms = n_docs + int((n > 0).sum()), n_terms + int(n.sum())
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[-2, -1], some]), pa.int64()),
                                          pa.array(np.concatenate([[n_docs, n_terms], df[some]]), pa.int64())], ["term", "n"])

    found = {r["term"]: r["n"] for r in docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    return found.pop(-2, 0), found.pop(-1, 0), found


def _binary(flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    offs = (np.concatenate([[0], ends]) * flat.itemsize).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offs), pa.py_buffer(flat.tobytes())])


def vectors(docs: DataFrame, block: Block) -> DataFrame:
    """(doc_id, bucket, terms, impacts) of every document that shares a term of positive weight with the items."""
    held = docs.sparkSession.sparkContext.broadcast(block)
    schema = T.StructType([docs.schema["doc_id"], T.StructField("bucket", T.IntegerType()), T.StructField("terms", T.BinaryType()),
                           T.StructField("impacts", T.BinaryType())])

    def run(batches):
        block = held.value
        for part in arrowtext.chunks(batches):
            n, row, term, tf = counted(*arrowtext.byte_view(part.column("text")), block.terms)
            row, term, tf = (x[block.w[term] > 0] for x in (row, term, tf))
            m = np.array([25 + 75 * a * block.n_docs // block.n_terms if a else 0 for a in n.tolist()], np.int64)
            impact = 1_000_000_000 * tf // (1000 * tf + 8 * m[row])
            square = np.bincount(row, weights=block.w[term] * impact.astype(float) ** 2, minlength=len(n))
            some = np.flatnonzero(square > 0)
            ends = np.cumsum(np.bincount(row, minlength=len(n))[some])
            bucket = np.floor(0.5 * np.log2(square[some]) * BUCKETS).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array(some)), pa.array(bucket), _binary(term.astype("<u4"), ends).cast(pa.binary()),
                 _binary(impact.astype("<u4"), ends).cast(pa.binary())], schema.names)

    found = docs.select("doc_id", "text").mapInArrow(run, schema)
    salt = F.pmod(F.xxhash64("doc_id", "terms"), F.lit(SALTS))
    return session.cut(found.repartition("bucket", salt).sortWithinPartitions(F.desc("bucket")))


class Bucket:
    """A slice of vectors of like norms, by document and by term."""

    def __init__(self, terms: list[bytes], impacts: list[bytes], block: Block):
        self.term, self.impact = np.frombuffer(b"".join(terms), "<u4").astype(np.int64), np.frombuffer(b"".join(impacts), "<u4").astype(np.int64)
        self.size = np.array([len(t) // 4 for t in terms])
        self.first = np.cumsum(self.size) - self.size
        row = np.repeat(np.arange(len(terms)), self.size)
        x = self.impact * block.scale[self.term]
        self.square = np.add.reduceat(x * x, self.first)
        self.longest = math.sqrt(self.square.max())
        order = np.argsort(self.term, kind="stable")
        self.by_term, self.row, self.x = self.term[order], row[order], x[order]

    def survivors(self, q: np.ndarray, focus: np.ndarray, rest: float, least: float) -> np.ndarray:
        """Rows whose bound reaches `least`; q: the item's scaled values at its `focus` terms, rest: the norm of the others."""
        part, left = np.zeros(len(self.size)), self.square.copy()
        for value, a, b in zip(q, np.searchsorted(self.by_term, focus), np.searchsorted(self.by_term, focus, "right"), strict=True):
            rows, x = self.row[a:b], self.x[a:b]
            part[rows] += value * x
            left[rows] -= x * x
        bound = part + rest * np.sqrt(np.maximum(left, 0) + 1e-9 * self.square)
        return np.flatnonzero(bound * MARGIN >= least)

    def scores(self, rows: np.ndarray, dense: np.ndarray) -> np.ndarray:
        """The exact scores of some rows; dense: the item's integer value at every term."""
        size = self.size[rows]
        first = np.cumsum(size) - size
        at = np.arange(int(size.sum())) + np.repeat(self.first[rows] - first, size)
        return np.add.reduceat(dense[self.term[at]] * self.impact[at], first)


def best_of(found: DataFrame, block: Block, least: list[int] | None, k: int, lead: bool) -> DataFrame:
    """(item, doc_id, score): each partition's k best of each item; `lead` reads only the first slice of a partition."""
    spark = found.sparkSession
    arrowtext.bounded_batches(spark)
    held = spark.sparkContext.broadcast((block, least))
    schema = T.StructType([T.StructField("item", T.LongType()), found.schema["doc_id"], T.StructField("score", T.LongType())])

    def run(batches):
        block, least = held.value
        best: list[list[tuple]] = [[] for _ in block.items]
        bound = list(least) if least else [1] * len(block.items)
        dense = np.zeros(len(block.terms.found), np.int64)
        scaled = []
        for term, count in block.items:
            q = count * block.scale[term]
            order = np.argsort(-q, kind="stable")
            focus = order[:FOCUS]
            scaled.append((q[focus], term[focus], math.sqrt((q[order[FOCUS:]] ** 2).sum()), math.sqrt((q ** 2).sum())))
        for n, (ids, bucket) in enumerate(_slices(batches, block)):
            if lead and n:
                continue  # the rest is read and left
            for item, (term, count) in enumerate(block.items):
                q, focus, rest, norm = scaled[item]
                if norm * bucket.longest * MARGIN < bound[item]:
                    continue
                rows = bucket.survivors(q, focus, rest, bound[item])
                if not len(rows):
                    continue
                dense[term] = count * block.w[term]
                score = bucket.scores(rows, dense)
                dense[term] = 0
                rows, score = rows[score >= bound[item]], score[score >= bound[item]]
                if len(rows):
                    new = [(-s, ids[r] is None, ids[r]) for s, r in zip(score.tolist(), rows.tolist(), strict=True)]
                    best[item] = sorted([*best[item], *new], key=_order)[:k]
                    if len(best[item]) == k:
                        bound[item] = max(bound[item], -best[item][-1][0])
        rows = [(item, d, -s) for item, own in enumerate(best) for s, _, d in own]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], schema.names)

    from pyspark.sql.pandas.types import to_arrow_type
    kinds = [to_arrow_type(f.dataType) for f in schema.fields]
    return found.select("doc_id", "terms", "impacts").mapInArrow(run, schema)


def _order(entry: tuple) -> tuple:
    return entry[:2] if entry[1] else entry


def _slices(batches, block: Block):
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            some = batch.slice(at, SLICE)
            yield some.column("doc_id").to_pylist(), Bucket(some.column("terms").to_pylist(), some.column("impacts").to_pylist(), block)


def search(docs: DataFrame, items: DataFrame, k: int = TOP, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of highest score above zero for each item row."""
    spark = docs.sparkSession
    arrowtext.bounded_batches(spark)
    best_first = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    out = None
    for ids, block in blocks(items, block_chars):
        block.weigh(*counts(docs, block))
        found = vectors(docs, block)
        lead = ranking.top_per_group(best_of(found, block, None, k, True), ["item"], best_first, k, ["doc_id"])
        known = {r["item"]: r["least"] for r in lead.groupBy("item").agg(F.min("score").alias("least"), F.count("*").alias("n")).where(F.col("n") == k).collect()}
        best = best_of(found, block, [known.get(i, 1) for i in range(len(ids))], k, False)
        names = spark.createDataFrame(list(enumerate(ids)), T.StructType([T.StructField("item", T.LongType()), items.schema["item_id"]]))
        ranked = ranking.top_per_group(best, ["item"], best_first, k, ["doc_id"], "rank").join(F.broadcast(names), "item")
        ranked = ranked.select("item_id", "rank", "doc_id", "score")
        out = ranked if out is None else out.unionByName(ranked)
    if out is None:
        empty = T.StructType([items.schema["item_id"], T.StructField("rank", T.IntegerType()), docs.schema["doc_id"], T.StructField("score", T.LongType())])
        out = spark.createDataFrame([], empty)
    return out
