"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A text's fingerprint has a bit set where over half of the XXH64 (seed 42) of its four-word shingles have it. Two fingerprints at
`radius` bits or fewer share a value within radius / 2 bits of both. So every distinct fingerprint emits all its variants
within half the radius; those that meet at a variant are linked.

Variants are shuffled by their leading bits: a fingerprint goes to each prefix that some variant of it has, and the task of a
prefix writes out the variants with it. That moves tens of rows per fingerprint instead of two thousand. All that meet at
one variant are within the radius of each other, so links to the first of them keep every component; they are deduplicated
and verified. Equal fingerprints are one node, so copies are never paired.

A prefix with very many fingerprints (`hot_rows`) is split by a hash of the variant.

Null and empty texts have the fingerprint zero, linked like any other. A null doc_id is never a component's id unless no other
is reachable (then it is null). Repeated rows are kept. Extra columns are kept, those named like an output column are replaced.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaymill import session
from assaymill.llm import arrowtext, components

SHINGLE = 4
SEED = 42
RADIUS = 4
BITS = 64
#: Variants that one task should write out for one prefix, and fingerprints of a prefix from which it is split.
VARIANTS_PER_PREFIX = 1 << 20
HOT_ROWS = 1 << 15


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """The fingerprint of one text as an unsigned integer."""
    import xxhash

    words = text.lower().split()  # bytes: A-Z only, and exactly the ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - size + 1)
    digest, total = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    first, last = starts[:n].tolist(), ends[-n:].tolist()
    for at in range(0, n, 1 << 14):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(first[at:at + (1 << 14)], last[at:at + (1 << 14)], strict=True)], np.uint64)
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, keep_text: bool = True, size: int = SHINGLE) -> DataFrame:
    """`docs` with `fp`, the fingerprint as a signed long."""
    arrowtext.bounded_batches(docs.sparkSession)
    kept = [f for f in docs.schema.fields if f.name != "fp" and (keep_text or f.name != "text")]

    def run(batches):
        for part in batches:
            found = np.array([fingerprint(t, size) for t in arrowtext.plain(part.column("text")).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*[part.column(f.name) for f in kept], pa.array(found.view(np.int64))],
                                             [*[f.name for f in kept], "fp"])

    return docs.mapInArrow(run, T.StructType([*kept, T.StructField("fp", T.LongType())]))


def flips(bits: int, most: int) -> np.ndarray:
    """All XOR masks over the lowest `bits` bits with at most `most` bits set."""
    return np.array([sum(1 << i for i in chosen) for k in range(most + 1) for chosen in combinations(range(bits), k)], np.uint64)


def prefix_bits(n: int, half: int) -> int:
    """Leading bits such that a prefix has about VARIANTS_PER_PREFIX variants."""
    balls = sum(math.comb(BITS, k) for k in range(half + 1))
    return min(20, max(6, math.ceil(math.log2(max(1, n) * balls / VARIANTS_PER_PREFIX))))


def met(fps: np.ndarray, prefix: int, bits: int, half: int, part: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (positions in `fps`) between fingerprints that share a variant with this prefix; of a split prefix, one part."""
    low = np.uint64((1 << (BITS - bits)) - 1)
    used = np.bitwise_count((fps >> np.uint64(BITS - bits)) ^ np.uint64(prefix))
    base, variants, owners = fps & low, [], []
    for spent in range(half + 1):
        mine = np.flatnonzero(used == spent)
        masks = flips(BITS - bits, half - spent)
        step = max(1, (1 << 20) // len(masks))
        for at in range(0, len(mine), step):
            some = mine[at:at + step]
            v = (base[some][:, None] ^ masks[None, :]).ravel()
            o = np.repeat(some, len(masks))
            if parts > 1:
                chosen = arrowtext.mix(v) % np.uint64(parts) == np.uint64(part)
                v, o = v[chosen], o[chosen]
            variants.append(v), owners.append(o)
    v, o = np.concatenate(variants), np.concatenate(owners)
    order = np.argsort(v)
    v, o = v[order], o[order]
    first = np.concatenate([[True], v[1:] != v[:-1]])
    at = np.flatnonzero(first)
    least = np.minimum.reduceat(o, at)[np.cumsum(first) - 1]
    pairs = np.unique((o * len(fps) + least)[o != least])
    return pairs // len(fps), pairs % len(fps)


def links(fingerprints: DataFrame, radius: int = RADIUS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Verified links (a, b) between distinct fingerprints `fp` whose components are those of all pairs within the radius."""
    half = math.ceil(radius / 2)
    bits = prefix_bits(fingerprints.count(), half)
    masks = flips(bits, half).astype(np.int64).tolist()
    top = F.shiftrightunsigned("fp", BITS - bits)
    sent = fingerprints.select("fp", F.explode(F.transform(F.lit(masks), lambda m: top.bitwiseXOR(m))).alias("prefix"))
    hot = (sent.groupBy("prefix").agg(F.count("*").alias("n")).where(F.col("n") > hot_rows)
           .select("prefix", F.ceil(F.col("n") / hot_rows).cast("int").alias("parts")))
    split = sent.join(hot, "prefix", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    split = split.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))

    def run(table: pa.Table) -> pa.Table:
        fps = np.sort(table.column("fp").to_numpy()).view(np.uint64)
        prefix, part, parts = (table.column(c)[0].as_py() for c in ("prefix", "part", "parts"))
        a, b = met(fps, prefix, bits, half, part, parts)
        near = np.bitwise_count(fps[a] ^ fps[b]) <= radius
        return pa.table({"a": fps[a[near]].view(np.int64), "b": fps[b[near]].view(np.int64)})

    return split.groupBy("prefix", "part").applyInArrow(run, "a long, b long").distinct()


def with_components(nodes: DataFrame, radius: int, hot_rows: int) -> DataFrame:
    """`nodes`, one row for each fingerprint `fp`, with `component`, a fingerprint that stands for all that are linked."""
    found = components.components(links(nodes.select("fp"), radius, hot_rows))
    return nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))


def clusters(docs: DataFrame, keep_text: bool = True, radius: int = RADIUS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """`docs` with `fingerprint` (16 hex digits) and `component_id`, the smallest doc_id reachable over links."""
    docs = docs.drop("fingerprint", "component_id")
    marked = with_fingerprints(docs, keep_text)
    marked = marked if keep_text else session.cut(marked)
    ids = session.cut(marked.select("doc_id", "fp")) if keep_text else marked.select("doc_id", "fp")
    nodes = session.cut(ids.groupBy("fp").agg(F.min("doc_id").alias("least")))
    classes = with_components(nodes, radius, hot_rows)
    least = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    named = classes.join(least, "component").select("fp", "component_id")
    return (marked.join(named, "fp").withColumn("fingerprint", F.lpad(F.lower(F.hex("fp")), 16, "0"))
            .select(*[c for c in marked.columns if c != "fp"], "fingerprint", "component_id"))


def keep_one(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One document of each component: that of the least id (null ids last), then fingerprint, then hash of id and text.

    A row is known by that hash, so null and repeated ids part nothing and join nothing. Of rows equal in both the least stays. The
    winner is chosen among ids and fingerprints; texts meet it in a join on the hash, and are not gathered by group.
    """
    told = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in ("doc_id", "text")]
    key = F.sha2(F.concat_ws("\n", *told), 256).alias("_key")
    marked = with_fingerprints(docs.select("doc_id", "text", key), keep_text=False)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_key")).alias("first")
    nodes = session.cut(marked.groupBy("fp").agg(first))
    best = F.min(F.struct("first.none", "first.doc_id", "fp", "first._key")).alias("best")
    winners = with_components(nodes, radius, HOT_ROWS).groupBy("component").agg(best).select("best._key")
    kept = docs.select("*", key).join(winners, "_key", "left_semi")
    return kept.groupBy("_key").agg(F.min(F.struct(*docs.columns)).alias("_row")).select("_row.*")
