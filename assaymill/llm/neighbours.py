"""Approximate nearest neighbours by multiprobe cross-polytope hashing.

A table has one or two pseudo-rotations (three rounds of random signs and a fast Hadamard transform, each). Each assigns a unit vector to
the nearest of the signed axes; its axes are its bucket. A query probes, in every table, the buckets whose axes it is nearest to, and
candidates are reranked by their inner product with the original vectors in double precision.

How many tables, axes and probes there are follows from a sample: for up to CALIBRATING queries and their nearest in SAMPLE vectors, the place
of each neighbour's bucket in the query's order of buckets tells how many probes any number of tables needs to reach TARGET of them;
the cheapest choice is taken. Neighbours in a sample are farther off than those in the whole table, so a sampled table is searched with more care,
not less. Vectors without structure need most buckets of one table; clustered ones few of many.

Inner products of vectors of unequal length are searched as cosines after one coordinate is added that brings every indexed
vector to the longest one's length.

Index and probes meet by (table, first axis); a second axis is matched inside. A query travels with the score of its BOUND-th best in the
sample (which gives no candidates): what is found below that is not sent on, and of each axis at most the 20 best. BOUND counts in the whole
table, several times 20; of a sampled table it is lowered by the sample's share, to 20 at least. Queries that end with fewer than
20 are searched again in all buckets of one table, without that bound. An axis with more than `hot_rows` vectors or `hot_queries` queries is
split by a hash of the id on either side, with the other side sent to each part.

Vectors that are null, zero, of another length than the longest, or that hold null or non-finite components take no part, nor do
null ids. Of rows that repeat an id, the vectors are all indexed and the best one counts. Equal scores go to the smaller id.
Extra columns are ignored.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assaymill import session
from assaymill.llm import sampling

#: Numbers of tables that are weighed against each other.
TABLES = (1, 2, 4, 8)
#: What indexing all vectors in one more table counts, as a share of reranking all of them.
TABLE_COST = 0.005
SAMPLE = 1 << 14
CALIBRATING = 64
#: Share of the calibrating queries' neighbours that the probes must reach.
TARGET = 0.97
#: A second axis is weighed where a bucket of two would hold this many vectors on average.
OCCUPIED = 4
BOUND = 64
NEAREST = 20
HOT_ROWS = 1 << 14
HOT_QUERIES = 1 << 13
#: Bucket scores that are held at once while probes are chosen.
SCORES = 1 << 22
SEED = 17
#: Scores this close to the cut are settled by the exact products.
SLACK = 1e-9


def usable(vectors: DataFrame, column: str = "embedding", key: str = "vec_id") -> tuple[DataFrame, int]:
    """(vec_id long, v array<double>) of the vectors that take part, and their length."""
    v = F.transform(F.col(column), lambda x: x.cast("double"))
    base = vectors.select(F.col(key).cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    size = base.agg(F.max(F.size("v"))).first()[0] or 0
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("v", lambda x: x != 0)
    return base.where((F.size("v") == size) & ~bad & some), size


class Rotations:
    """The tables' pseudo-rotations, the same in every task."""

    def __init__(self, size: int, longest: float, equal: bool, tables: int):
        self.longest, self.equal = longest, equal
        self.width = 2
        while self.width < size + (not equal):
            self.width *= 2
        self.signs = np.random.Generator(np.random.PCG64(SEED)).integers(0, 2, (2 * tables, 3, self.width)) * 2.0 - 1

    def units(self, x: np.ndarray, query: bool) -> np.ndarray:
        out = np.zeros((len(x), self.width))
        norm = np.linalg.norm(x, axis=1)
        if query or self.equal:
            out[:, :x.shape[1]] = x / norm[:, None]
        else:
            out[:, :x.shape[1]] = x / self.longest
            out[:, x.shape[1]] = np.sqrt(np.maximum(0, 1 - (norm / self.longest) ** 2))
        return out

    def scores(self, units: np.ndarray, which: int) -> np.ndarray:
        """The nearness of each vector to the signed axes after one rotation."""
        y = units
        for signs in self.signs[which]:
            y = hadamard(y * signs)
        return np.concatenate([y, -y], axis=1)


def hadamard(x: np.ndarray) -> np.ndarray:
    """The orthonormal fast Hadamard transform of each row."""
    n, step = x.shape[1], 1
    while step < n:
        y = x.reshape(len(x), n // (2 * step), 2, step)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), n)
        step *= 2
    return x / np.sqrt(n)


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def best_of(query: np.ndarray, query_id: int, ids: np.ndarray, x: np.ndarray, most: int, least: float):
    """(ids, scores) of the `most` largest inner products of at least `least`, ties to smaller ids; the query's own id is out."""
    rough = x @ query
    chosen = np.flatnonzero((rough >= least - SLACK) & (ids != query_id))
    if len(chosen) > most:
        cut = np.partition(rough[chosen], -most)[-most]
        chosen = chosen[rough[chosen] >= cut - SLACK]
    exact = np.einsum("ij,j->i", x[chosen], query, optimize=False)
    order = np.lexsort([ids[chosen], -exact])[:most]
    return ids[chosen][order], exact[order]


class Probing(NamedTuple):
    """How the tables are used: hashed axes of a bucket, tables, and buckets that a query probes in each."""
    axes: int
    tables: int
    probes: int


def calibrated(rotations: Rotations, ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, most: int, n: int) -> Probing:
    """The cheapest use of the tables that reaches TARGET of the queries' `most` nearest in the sample `x`; n: vectors in all."""
    width = 2 * rotations.width
    near = [best_of(q[i], query_ids[i], np.arange(len(x)), x[:, :], most + 1, -np.inf)[0] for i in range(len(q))]
    near = [[j for j in found if ids[j] != query_ids[i]][:most] for i, found in enumerate(near)]
    owner = np.repeat(np.arange(len(q)), [len(f) for f in near])
    mine = np.array([j for f in near for j in f], np.int64)
    if not len(mine):
        return Probing(1, 1, width)
    asked, held = rotations.units(q, query=True), rotations.units(x[mine], query=False)
    best, choices = {}, []
    for t in range(max(TABLES)):
        a, b = (rotations.scores(asked, 2 * t + k) for k in (0, 1))
        first, second = (rotations.scores(held, 2 * t + k).argmax(axis=1) for k in (0, 1))
        own = a[owner, first]
        places = {1: (a[owner] > own[:, None]).sum(axis=1) + 1}
        if n >= OCCUPIED * width ** 2:
            limit, order = own + b[owner, second], np.sort(b, axis=1)
            places[2] = np.array([1 + int((width - np.searchsorted(order[o], s - a[o], side="right")).sum()) for o, s in zip(owner, limit, strict=True)])
        for k, place in places.items():
            best[k] = np.minimum(best[k], place) if k in best else place
            if t + 1 in TABLES:
                probes = int(np.sort(best[k])[math.ceil(TARGET * len(place)) - 1])
                choices.append(((t + 1) * (probes / width ** k + TABLE_COST), t + 1, Probing(k, t + 1, probes)))
    return min(choices, key=lambda c: c[:2])[2]


def search(vectors: DataFrame, queries: DataFrame, size: int, most: int = NEAREST, sample: int = SAMPLE, hot_rows: int = HOT_ROWS,
           hot_queries: int = HOT_QUERIES, probing: Probing | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score) for usable `queries` against usable `vectors` (see `usable`). probing: instead of calibration."""
    spark = vectors.sparkSession
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    low, high, n, n_ids = vectors.agg(F.min(length), F.max(length), F.count("*"), F.approx_count_distinct("vec_id")).first()
    if low is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rotations = Rotations(size, high, high - low <= 1e-5 * high, max(TABLES))
    picked, asked = sampling.by_hash(vectors, sample), sampling.by_hash(queries, CALIBRATING)
    ids, x = picked["vec_id"].to_numpy(), matrix(picked["v"])
    if probing is None:
        probing = calibrated(rotations, ids, x, asked["vec_id"].to_numpy(), matrix(asked["v"]), most, n)
    bound = max(most, math.ceil(max(BOUND, 3 * most) * min(1.0, picked.num_rows / n_ids)))
    shared = spark.sparkContext.broadcast((ids, x, rotations))
    found = session.cut(_search(vectors, queries, shared, probing, bound, most, hot_rows, hot_queries))
    full = found.groupBy("query_id").count().where(F.col("count") >= most).select(F.col("query_id").alias("vec_id"))
    short = session.cut(queries.join(full, "vec_id", "left_anti"))
    if not short.isEmpty():
        every = Probing(1, 1, 2 * rotations.width)
        again = _search(vectors, short, shared, every, 0, most, hot_rows, hot_queries)
        found = found.join(full.withColumnRenamed("vec_id", "query_id"), "query_id", "left_semi").unionByName(again)
    return found


def _search(vectors: DataFrame, queries: DataFrame, shared, probing: Probing, bound: int, most: int, hot_rows: int, hot_queries: int) -> DataFrame:
    """The answers of one use of the tables; bound: rank in the sample whose score prunes, 0 for none."""
    k, tables, probes = probing

    def index(whole):
        def run(batches):
            _, _, rot = shared.value
            for part in _slices(batches, (2 * rot.width)):
                units = rot.units(matrix(part.column("v")), query=False)
                for t in range(tables):
                    first = rot.scores(units, 2 * t).argmax(axis=1).astype(np.int32)
                    second = rot.scores(units, 2 * t + 1).argmax(axis=1).astype(np.int32) if k == 2 else np.zeros(len(units), np.int32)
                    own = [pa.array(np.full(len(units), t, np.int32)), pa.array(first)]
                    names = ["table", "axis"]
                    yield pa.RecordBatch.from_arrays(own + [part.column("vec_id"), pa.array(second), part.column("v")] * whole,
                                                     names + ["vec_id", "other", "v"] * whole)
        return run

    def probe(whole):
        def run(batches):
            ids, x, rot = shared.value
            width = 2 * rot.width
            for part in _slices(batches, width ** k):
                q, mine = matrix(part.column("v")), part.column("vec_id").to_numpy()
                units = rot.units(q, query=True)
                least = np.full(len(q), -np.inf)
                for i in range(len(q) if bound and whole else 0):
                    near, score = best_of(q[i], mine[i], ids, x, bound, -np.inf)
                    distinct = len(np.unique(near)) == len(near)
                    least[i] = score[-1] if len(near) == bound and distinct else -np.inf
                for t in range(tables):
                    score = rot.scores(units, 2 * t)
                    if k == 2:
                        score = (score[:, :, None] + rot.scores(units, 2 * t + 1)[:, None, :]).reshape(len(q), -1)
                    n = min(probes, score.shape[1])
                    top = np.argpartition(-score, n - 1, axis=1)[:, :n]
                    rows = []
                    for i in range(len(q)):
                        axes, others = np.divmod(np.sort(top[i]), width if k == 2 else 1)
                        used, start = np.unique(axes, return_index=True)
                        rows += [(int(g), o.tolist(), i) for g, o in zip(used, np.split(others, start[1:]), strict=True)]
                    at = np.array([r[2] for r in rows])
                    own = [pa.array(np.full(len(rows), t, np.int32)), pa.array([r[0] for r in rows], pa.int32())]
                    more = [part.column("vec_id").take(pa.array(at)), pa.array([r[1] for r in rows], pa.list_(pa.int32())), part.column("v").take(pa.array(at)),
                            pa.array(least[at])] if whole else []
                    yield pa.RecordBatch.from_arrays(own + more, ["table", "axis", "query_id", "others", "q", "least"][:2 + len(more)])
        return run

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, out = left["vec_id"].to_numpy(), []
        if len(ids) and right.num_rows:
            x, other = matrix(left["v"]), left["other"].to_numpy()
            order = np.argsort(other, kind="stable")
            ids, x, other = ids[order], x[order], other[order]
            q, query_id, least = matrix(right["q"]), right["query_id"].to_numpy(), right["least"].to_numpy()
            for i, others in enumerate(right["others"].to_pylist()):
                if k == 1:
                    near, score = best_of(q[i], query_id[i], ids, x, most, least[i])
                else:
                    spans = np.searchsorted(other, [others, [o + 1 for o in others]])
                    rows = np.concatenate([np.arange(a, b) for a, b in spans.T])
                    near, score = best_of(q[i], query_id[i], ids[rows], x[rows], most, least[i])
                if len(near):
                    out.append((np.full(len(near), query_id[i]), near, score))
        cols = [np.concatenate([o[c] for o in out]) if out else np.zeros(0, kind) for c, kind in enumerate((np.int64, np.int64, np.float64))]
        return pa.table({"query_id": cols[0], "vec_id": cols[1], "score": cols[2]})

    pair = "table int, axis int"
    indexed = vectors.select("vec_id", "v").mapInArrow(index(True), pair + ", vec_id long, other int, v array<double>")
    probed = queries.select("vec_id", "v").mapInArrow(probe(True), pair + ", query_id long, others array<int>, q array<double>, least double")
    by_axis = vectors.select("vec_id", "v").mapInArrow(index(False), pair).groupBy("table", "axis").agg(F.count("*").alias("n"), F.lit(0).alias("m"))
    asked = queries.select("vec_id", "v").mapInArrow(probe(False), pair).groupBy("table", "axis").agg(F.lit(0).alias("n"), F.count("*").alias("m"))
    counts = by_axis.unionByName(asked).groupBy("table", "axis").agg(F.sum("n").alias("n"), F.sum("m").alias("m")).where("n > 0 AND m > 0")
    parts = counts.select("table", "axis", F.ceil(F.col("n") / hot_rows).cast("int").alias("parts"), F.ceil(F.col("m") / hot_queries).cast("int").alias("turns"))
    parts = F.broadcast(session.cut(parts))  # at most one row per table and axis

    def spread(df, own, other, key):
        """A row's own part by its hash, and one copy for each part of the other side."""
        return (df.join(parts, ["table", "axis"]).withColumn(f"_{own}", F.pmod(F.xxhash64(key), F.col(own)).cast("int"))
                .withColumn(f"_{other}", F.explode(F.sequence(F.lit(0), F.col(other) - 1))).drop("parts", "turns"))

    left, right = spread(indexed, "parts", "turns", "vec_id"), spread(probed, "turns", "parts", "query_id")
    key = ["table", "axis", "_parts", "_turns"]
    met = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(meet, "query_id long, vec_id long, score double")
    one = met.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (one.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
            .select("query_id", "rank", "vec_id", "score"))


def _slices(batches, scores: int):
    """Slices of the batches for which `scores` numbers a row stay within SCORES."""
    step = max(1, SCORES // scores)
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)
