"""Language identification with interpolated Kneser-Ney character models in sorted hash arrays.

Texts are lower-cased, everything but letters becomes one blank, three blanks stand before a text and one after it. Per
language, character 4-grams are counted over all learning documents (one aggregation); the lower orders are Kneser-Ney
continuation counts of the orders above. Every 4-gram is kept. The interpolated probabilities of every n-gram stand in sorted
arrays of 64-bit hashes, found through an index over their leading bits.

The models are dealt into shards of bounded size: several languages, one language, or a range of the third symbols of a language
(all counts that a 4-gram needs, but those of single symbols and the discounts, share its third symbol). Shards are gathered and
broadcast one by one; a text's surprisal is the sum over them, so the shard size changes no result. With one shard the texts are
scored where they lie; with more, each shard's sums of a row meet by a key of the row.

A text gets the language of lowest cross-entropy per character. It is rejected (`rejected`) where that cross-entropy lies beyond
what documents of the language showed on a calibration share of the learning documents, with an allowance for short texts,
and where it has no letter (language `und`, score 0).

Documents learn where their language is not null and crc32(doc_id as text) mod 4 is not 2: shares 0 and 1 give the counts, share
3 the calibration (and counts for a language that the others lack). A null id takes part in nothing but the prediction.

Without any learning document every text is `und`. Repeated rows get equal results; extra columns are kept, those named like
an output column are replaced.
"""

from __future__ import annotations

from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaymill import session
from assaymill.llm import arrowtext
from assaymill.llm.rowkeys import row_key

ORDER = 4
HELD_OUT = 2
CALIBRATION = 3
FOLDS = 4
SYMBOLS = 1 << 16
#: 4-grams of a shard times its languages; only the 4-grams of a single third symbol of a language can be more.
SHARD_CELLS = 8_000_000
#: Distinct 4-grams that a counting task holds before it hands them on.
HELD_GRAMS = 1_000_000
#: Text bytes scored at once, for up to four languages.
SCORED_BYTES = 2 << 20
#: Of a language's calibration documents, the share that its limit covers before the allowances.
COVERED = 0.999
UNKNOWN = "und"

ADDED = ["lang_pred", "score", "cross_entropy", "rejected"]
BLANK = np.uint64(0x20)


def letter_table() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def symbols(texts: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(16-bit symbols of all texts with their padding, the row of each)."""
    lowered = [t.lower() for t in texts]
    code = np.frombuffer("".join(f"\0\0\0{t}\0" for t in lowered).encode("utf-32-le"), np.uint32)
    size = np.array([len(t) + 4 for t in lowered], np.int64)
    ends = np.cumsum(size)
    pad = np.zeros(len(code), bool)
    for k in (0, 1, 2):
        pad[ends - size + k] = True
    pad[ends - 1] = True
    sym = np.where(letters[code], (code ^ (code >> 16) * 0x9E5) & 0xFFFF, 0x20).astype(np.uint64)
    keep = np.ones(len(code), bool)
    keep[1:] = (sym[1:] != BLANK) | (sym[:-1] != BLANK)
    keep |= pad
    return sym[keep], np.repeat(np.arange(len(texts)), size)[keep]


def grams(sym: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(packed 4-grams, row of each), within rows."""
    if len(sym) < ORDER:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    key = sym[:-3] << np.uint64(48) | sym[1:-2] << np.uint64(32) | sym[2:-1] << np.uint64(16) | sym[3:]
    same = row[:-3] == row[3:]
    return key[same], row[:-3][same]


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n): all 4-grams of each language over all the given documents."""
    def run(batches):
        letters = letter_table()
        waiting: dict[str, list] = {}

        def settle():
            for lang, parts in waiting.items():
                u, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
                waiting[lang] = [(u, np.bincount(at, weights=np.concatenate([n for _, n in parts])).astype(np.int64))]

        def held():
            return sum(len(k) for parts in waiting.values() for k, _ in parts)

        def out():
            for lang, [(key, n)] in waiting.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(key), pa.string()), pa.array(key.view(np.int64)), pa.array(n)],
                                                 ["lang", "gram", "n"])
            waiting.clear()

        for part in arrowtext.chunks(batches, limit=SCORED_BYTES):
            langs = np.array(part.column("lang").to_pylist(), object)
            texts = arrowtext.texts(part.column("text"))
            for lang in sorted(set(langs)):
                key, _ = grams(*symbols([texts[i] for i in np.flatnonzero(langs == lang)], letters))
                waiting.setdefault(lang, []).append(np.unique(key, return_counts=True))
            if held() > 2 * HELD_GRAMS:
                settle()
                if held() > HELD_GRAMS:
                    yield from out()
        settle()
        yield from out()

    rows = docs.select("lang", "text").mapInArrow(run, "lang string, gram long, n long")
    return rows.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class HashArray:
    """A sorted array of hashed keys with a row of values for each, found through an index over the leading bits."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        h = arrowtext.mix(keys)
        order = np.argsort(h)
        self.hash, self.values = h[order], values[order]
        self.bits = max(1, int(len(keys)).bit_length())
        top = (self.hash >> np.uint64(64 - self.bits)).astype(np.int64)
        self.first = np.searchsorted(top, np.arange((1 << self.bits) + 1)).astype(np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, or -1."""
        h = arrowtext.mix(keys)
        top = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        at, last = self.first[top], self.first[top + 1]
        out = np.full(len(keys), -1, np.int32)
        left = np.flatnonzero(at < last)
        at = at[left]
        while len(left):
            here = self.hash[at]
            want = h[left]
            same = here == want
            out[left[same]] = at[same]
            at += 1
            more = (here < want) & (at < last[left])
            left, at = left[more], at[more]
        return out


class Model:
    """Interpolated Kneser-Ney models of some languages; `log` has every 4-gram seen in any of them.

    `shared` gives for each language the discounts of the four orders and all its single symbols with their counts; `floor` is the
    probability of a symbol before any count. Both are taken from the counts where they are not given, as is right where
    the counts are all there are. `cells` is the range of third symbols that the counts cover.
    """

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]], shared: dict | None = None, floor: float | None = None,
                 cells: tuple[int, int] = (0, SYMBOLS)):
        self.langs = sorted(counts)
        self.cells = cells
        n_langs = len(self.langs)
        tables = [self._orders(*counts[lang], *(shared[lang] if shared else (None, None))) for lang in self.langs]
        if floor is None:
            floor = 1.0 / (len({int(k) for t in tables for k in t[1][0]}) + 1)
        self.floor = np.full(n_langs, floor, np.float32)
        self.prob: dict[int, HashArray] = {}
        self.back: dict[int, HashArray] = {}
        for k in range(1, ORDER + 1):
            contexts = np.unique(np.concatenate([t[k][2] for t in tables]))
            back = np.ones((len(contexts), n_langs), np.float32)
            for j, t in enumerate(tables):
                back[np.searchsorted(contexts, t[k][2]), j] = t[k][3]
            self.back[k] = HashArray(contexts, back)
            keys = np.unique(np.concatenate([t[k][0] for t in tables]))
            own = np.zeros((len(keys), n_langs), np.float32)
            for j, t in enumerate(tables):
                own[np.searchsorted(keys, t[k][0]), j] = t[k][1]
            self.prob[k] = HashArray(keys, np.zeros((len(keys), n_langs), np.float32))
            h = HashArray(keys, own + self._backed(keys, k))
            self.prob[k] = h
        top = self.prob[ORDER]
        self.log = -np.log(top.values)

    @staticmethod
    def _orders(keys: np.ndarray, n: np.ndarray, discounts: dict[int, float] | None, single: tuple | None) -> dict[int, tuple]:
        """Per order: keys, discounted share of each, contexts, back-off weight of each."""
        out = {}
        for k in range(ORDER, 0, -1):
            if k == 1 and single is not None:
                keys, n = single
            d = discounts[k] if discounts else discount(int((n == 1).sum()), int((n == 2).sum()))
            context, at = np.unique(keys >> np.uint64(16), return_inverse=True)
            total, types = np.bincount(at, weights=n), np.bincount(at)
            out[k] = (keys, (np.maximum(n - d, 0) / total[at]).astype(np.float32), context, (d * types / total).astype(np.float32))
            keys, n = np.unique(keys & np.uint64((1 << 16 * (k - 1)) - 1), return_counts=True)
        return out

    def _backed(self, keys: np.ndarray, k: int) -> np.ndarray:
        """Back-off weight of the contexts times the probability one order below."""
        at = self.back[k].find(keys >> np.uint64(16))
        weight = np.where((at >= 0)[:, None], self.back[k].values[at], np.float32(1))
        return weight * self.probability(keys & np.uint64((1 << 16 * (k - 1)) - 1), k - 1)

    def probability(self, keys: np.ndarray, k: int) -> np.ndarray:
        """P(last symbol | the others) for each key and language."""
        if k == 0:
            return np.broadcast_to(self.floor, (len(keys), len(self.langs)))
        at = self.prob[k].find(keys)
        out = self.prob[k].values[at]
        missing = np.flatnonzero(at < 0)
        if len(missing):
            out[missing] = self._backed(keys[missing], k)
        return out

    def surprisal(self, keys: np.ndarray) -> np.ndarray:
        """-log P of each 4-gram and language."""
        at = self.prob[ORDER].find(keys)
        out = self.log[at]
        missing = np.flatnonzero(at < 0)
        if len(missing):
            out[missing] = -np.log(self._backed(keys[missing], ORDER))
        return out

    def sums(self, texts: list[str], letters: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per text: sum of the surprisal and of its square by language, over the 4-grams of the model's cells; all 4-grams; letters.

        Only a text longer than `step` is summed in pieces of it.
        """
        sym, row = symbols(texts, letters)
        key, owner = grams(sym, row)
        n = np.bincount(owner, minlength=len(texts))
        n_letters = np.bincount(row[sym != BLANK], minlength=len(texts))
        if self.cells != (0, SYMBOLS):
            cell = (key >> np.uint64(16) & np.uint64(SYMBOLS - 1)).astype(np.int64)
            mine = (cell >= self.cells[0]) & (cell < self.cells[1])
            key, owner = key[mine], owner[mine]
        total, square = np.zeros((len(texts), len(self.langs))), np.zeros((len(texts), len(self.langs)))
        for lo in range(0, len(key), step):
            s, of = self.surprisal(key[lo:lo + step]), owner[lo:lo + step]
            first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            total[of[first]] += np.add.reduceat(s, first, axis=0, dtype=np.float64)
            square[of[first]] += np.add.reduceat(s * s, first, axis=0, dtype=np.float64)
        return total, square, n, n_letters

    def judge(self, texts: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per text: cross-entropy by language, scored symbols, letters, variance of the surprisal by language."""
        total, square, n, n_letters = self.sums(texts, letters, 2 * SCORED_BYTES)
        some = np.maximum(n, 1)[:, None]
        entropy = total / some
        return entropy, n, n_letters, np.maximum(square / some - entropy ** 2, 0)


def fold() -> Column:
    """crc32 of the id as text, mod 4; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS


def discount(ones: int, twos: int) -> float:
    """The absolute discount for that many counts of 1 and 2."""
    return ones / (ones + 2 * twos) if ones and twos else 0.5


class Models(dict):
    """{language: number of its 4-grams}; `shards` are broadcast arguments of Model, in an order that `held` names the languages of."""

    def __init__(self, sizes: dict[str, int], shards: list[Broadcast], held: list[list[str]]):
        super().__init__(sizes)
        self.shards, self.held = shards, held


def deal(cells: dict[str, list[tuple[int, int]]], most: int) -> list[tuple[list[str], tuple[int, int]]]:
    """Shards as (languages, range of third symbols): `cells` has (third symbol, its 4-grams) of each language in order."""
    out, together = [], []
    total = 0
    for lang in sorted(cells):
        size = sum(n for _, n in cells[lang])
        if size > most:
            first, held = 0, 0
            for cell, n in cells[lang]:
                if held and held + n > most:
                    out.append(([lang], (first, cell)))
                    first, held = cell, 0
                held += n
            out.append(([lang], (first, SYMBOLS)))
            continue
        if together and (total + size) * (len(together) + 1) > most:
            out.append((together, (0, SYMBOLS)))
            together, total = [], 0
        together, total = [*together, lang], total + size
    return out + ([(together, (0, SYMBOLS))] if together else [])


def third(gram: str) -> Column:
    """The third symbol of a packed 4-gram."""
    return F.shiftrightunsigned(gram, 16).bitwiseAND(SYMBOLS - 1)


def models(counts: DataFrame, shard_cells: int) -> Models:
    """The shards of the given (lang, gram, n); what is shared by a language's shards comes from aggregations over all counts."""
    spark = counts.sparkSession
    orders = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):
        shorter = F.col("gram").bitwiseAND((1 << 16 * k) - 1).alias("gram")
        orders[k] = orders[k + 1].groupBy("lang", shorter).agg(F.count("*").alias("n"))
    few = [rows.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("ones"), F.count_if(F.col("n") == 2).alias("twos"))
           .select("lang", F.lit(k).alias("order"), "ones", "twos") for k, rows in orders.items()]
    discounts: dict[str, dict[int, float]] = {}
    for r in reduce(DataFrame.union, few).collect():
        discounts.setdefault(r["lang"], {})[r["order"]] = discount(r["ones"], r["twos"])
    single = _by_language(orders[1])
    cells: dict[str, list[tuple[int, int]]] = {}
    for r in sorted(counts.groupBy("lang", third("gram").alias("cell")).count().collect()):
        cells.setdefault(r["lang"], []).append((r["cell"], r["count"]))
    floor = 1.0 / (len({int(g) for keys, _ in single.values() for g in keys}) + 1)
    shards, held = [], []
    for langs, (first, end) in deal(cells, shard_cells):
        rows = _by_language(counts.where(F.col("lang").isin(langs) & (third("gram") >= first) & (third("gram") < end)))
        shards.append(spark.sparkContext.broadcast((rows, {g: (discounts[g], single[g]) for g in langs}, floor, (first, end))))
        held.append(langs)
    return Models({g: sum(n for _, n in c) for g, c in cells.items()}, shards, held)


def _by_language(rows: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """{lang: (sorted grams, counts)}"""
    table = rows.select("lang", "gram", "n").toArrow()
    lang, gram, n = (table[c].combine_chunks() for c in ("lang", "gram", "n"))
    codes = lang.dictionary_encode()
    code, gram, n = codes.indices.to_numpy(), gram.to_numpy().view(np.uint64), n.to_numpy()
    order = np.lexsort((gram, code))
    ends = np.searchsorted(code[order], np.arange(len(codes.dictionary) + 1))
    return {g: (gram[order[a:b]], n[order[a:b]]) for g, a, b in zip(codes.dictionary.to_pylist(), ends[:-1], ends[1:])}


def learn(docs: DataFrame, shard_cells: int = SHARD_CELLS) -> tuple[dict, dict]:
    """(the models, {lang: (limit, allowance)}) from the learning documents."""
    arrowtext.bounded_batches(docs.sparkSession)
    known = docs.where(F.col("lang").isNotNull() & (fold() != HELD_OUT)).select("doc_id", "lang", "text")
    sizes = known.groupBy("lang").agg(F.max((fold() != CALIBRATION).cast("int")).alias("counted")).collect()
    if not sizes:
        return {}, {}
    lone = [r["lang"] for r in sizes if not r["counted"]]
    learned = models(session.cut(gram_counts(known.where((fold() != CALIBRATION) | F.col("lang").isin(lone)))), shard_cells)
    if not learned:
        return {}, {}
    judged = predict(known.where(fold() == CALIBRATION), (learned, {}), keep_text=False, detail=True)
    right = judged.where((F.col("lang") == F.col("lang_pred")) & (F.col("_n") > 0))
    limits = right.groupBy("lang_pred").agg(F.percentile_approx("cross_entropy", [0.5, COVERED], 10000).alias("q"),
                                            F.avg("_variance").alias("v")).collect()
    return learned, {r["lang_pred"]: (r["q"][1] + 3 * (r["q"][1] - r["q"][0]), 4 * r["v"] ** 0.5) for r in limits}


SUMS = [T.StructField("_sums", T.ArrayType(T.DoubleType())), T.StructField("_squares", T.ArrayType(T.DoubleType())),
        T.StructField("_n", T.LongType()), T.StructField("_letters", T.LongType())]


def shard_sums(docs: DataFrame, shard: Broadcast, keep: list[str]) -> DataFrame:
    """The columns `keep` of `docs` with SUMS for the languages of one shard."""
    fields = [docs.schema[c] for c in keep] + SUMS

    def run(batches):
        letters, model = letter_table(), Model(*shard.value)
        limit = SCORED_BYTES * 4 // max(4, len(model.langs))
        for part in arrowtext.chunks(batches, limit=limit):
            total, square, n, n_letters = model.sums(arrowtext.texts(part.column("text")), letters, 2 * limit)
            ends = pa.array(np.arange(len(n) + 1, dtype=np.int32) * len(model.langs))
            arrays = [pa.ListArray.from_arrays(ends, pa.array(a.ravel())) for a in (total, square)]
            arrays += [pa.array(a.astype(np.int64)) for a in (n, n_letters)]
            yield pa.RecordBatch.from_arrays([part.column(c) for c in keep] + arrays, [f.name for f in fields])

    return docs.mapInArrow(run, T.StructType(fields))


def all_sums(docs: DataFrame, learned: Models, keep: list[str]) -> DataFrame:
    """The columns `keep` of `docs` with SUMS for all languages in order."""
    if len(learned.shards) == 1:
        return shard_sums(docs, learned.shards[0], keep)
    keyed = docs.withColumn("_key", row_key("doc_id"))
    parts = [shard_sums(keyed.select("_key", "text"), shard, ["_key"]).withColumn("_shard", F.lit(i)) for i, shard in enumerate(learned.shards)]
    rows = reduce(DataFrame.union, parts).dropDuplicates(["_key", "_shard"])
    met = rows.groupBy("_key").agg(F.sort_array(F.collect_list(F.struct("_shard", *(f.name for f in SUMS)))).alias("_parts"))
    places = [[(i, held.index(g)) for i, held in enumerate(learned.held) if g in held] for g in sorted(learned)]

    def summed(name: str) -> Column:
        return F.array(*[reduce(add, [F.get(F.get("_parts", F.lit(i))[name], F.lit(j)) for i, j in some]) for some in places]).alias(name)

    sums = met.select("_key", summed("_sums"), summed("_squares"), F.get("_parts", F.lit(0))["_n"].alias("_n"),
                      F.get("_parts", F.lit(0))["_letters"].alias("_letters"))
    return keyed.select("_key", *keep).join(sums, "_key").select(*keep, *(f.name for f in SUMS))


def predict(docs: DataFrame, learned: tuple[dict, dict], keep_text: bool = True, detail: bool = False) -> DataFrame:
    """`docs` with ADDED columns; detail adds the number of scored symbols and the variance of their surprisal."""
    arrowtext.bounded_batches(docs.sparkSession)
    found, limits = learned
    kept = [c for c in docs.columns if c not in ADDED and (keep_text or c != "text")]
    more = ["_n", "_variance"] if detail else []
    if not found:
        return docs.select(*kept, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0.0).alias("cross_entropy"),
                           F.lit(True).alias("rejected"), *[F.lit(0).cast("long" if c == "_n" else "double").alias(c) for c in more])
    langs = sorted(found)
    bounds = [limits.get(g, (float("inf"), 0.0)) for g in langs]
    rows = all_sums(docs.drop(*ADDED), found, kept)
    some = F.greatest("_n", F.lit(1)).cast("double")
    rows = rows.withColumn("_entropy", F.transform("_sums", lambda x: x / some))
    rows = rows.withColumn("cross_entropy", F.array_min("_entropy"))
    rows = rows.withColumn("_at", F.array_position("_entropy", F.col("cross_entropy")).cast("int"))
    close = F.aggregate("_entropy", F.lit(0.0), lambda total, e: total + F.exp(-F.least("_n", F.lit(50)) * (e - F.col("cross_entropy"))))
    limit, allowance = (F.element_at(F.array(*[F.lit(b[i]) for b in bounds]), F.col("_at")) for i in (0, 1))
    none = F.col("_letters") == 0
    return rows.select(
        *kept, F.when(none, UNKNOWN).otherwise(F.element_at(F.array(*map(F.lit, langs)), F.col("_at"))).alias("lang_pred"),
        F.when(none, 0.0).otherwise(1 / close).alias("score"), "cross_entropy",
        (none | (F.col("cross_entropy") > limit + allowance / F.sqrt(some))).alias("rejected"),
        *(["_n", F.greatest(F.element_at("_squares", F.col("_at")) / some - F.col("cross_entropy") ** 2, F.lit(0.0)).alias("_variance")]
          if detail else []))
