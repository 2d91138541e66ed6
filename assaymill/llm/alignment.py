"""Cross-tokenizer alignment by pointer jumping, with the corpus-wide frequency of every pair of linked ids.

Both tokenizers cover the same bytes: a blank and the text. Every token points to the farthest-right token that overlaps it (among
all tokens of a chunk, laid end to end); where both sides end together the second side's token is the last and points to itself.
Doubling the successors (`succ[succ]`, all tokens at once) until nothing changes takes each token to the last one of its component, which
labels its group. Overlaps are the ranges between consecutive token ends of either side; each is one link.

Corpus-wide counts go by chunks of documents: a task sends the distinct id pairs of a chunk with the number of documents that hold each, not
one row a link or document. Their sums meet the chunks' pairs again in a join on the pair, and each chunk gets its own pairs'
counts beside the compact links of its documents. The best partner of a first-side id is an aggregate over the sums, no larger than its vocabulary.

Texts are encoded by distinct units that neither tokenizer's tokens cross: matches of the byte-level pattern, and runs from a blank to the
next blank after a non-blank (checked on the vocabulary). Very long texts are cut before single blanks between words, where both sides end.

Null and empty texts, and those whose joined token bytes are not the blank and the text on either side, have no tokens: zeros and ''.
Repeated rows are documents of their own. Extra columns are kept, those named like an output column are replaced.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaymill import session
from assaymill.llm import arrowtext, bpe

#: A vocabulary file of more bytes than this is refused: it travels to every executor.
MAX_VOCABULARY_BYTES = 64 << 20
#: Characters of text that are aligned at once.
SLICE_CHARS = 1 << 20
#: Bytes of the units whose ids a task keeps for each side; a full cache starts anew.
CACHE_BYTES = 4 << 20
#: Pairs that a task sums before it sends them.
SUM_PAIRS = 2_000_000

ADDED = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
_CUT = re.compile(r"(?<=\S) (?=\S)")


def read_vocabulary(path: str) -> bytes:
    with open(path, "rb") as f:
        data = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"vocabulary {path} has over {MAX_VOCABULARY_BYTES} bytes")
    return data


class Side:
    """One tokenizer: `starts` cuts a chunk into units, `encode` gives the ids of units, `tokens` the bytes of each id."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.size = np.array([len(t) for t in tokens], np.int64)
        digits = [str(i).encode() for i in range(len(tokens))]
        self.n_digits = np.array([len(d) for d in digits], np.int64)
        self.digits = np.frombuffer(b"".join(d.ljust(len(digits[-1])) for d in digits), np.uint8).reshape(len(digits), -1)
        self.known: dict[bytes, bytes] = {}
        self.bad: set[bytes] = set()
        self.held = 0

    def units(self, data: bytes, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all units in turn, number of ids of each unit, whether the ids' bytes are the unit's)."""
        offs = np.append(at, len(data))
        coded = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offs), pa.py_buffer(data)]).dictionary_encode()
        raw = coded.dictionary.to_pylist()
        if self.held > CACHE_BYTES:
            self.known.clear()
            self.bad.clear()
            self.held = 0
        self.learn([u for u in raw if u not in self.known])
        found = [self.known[u] for u in raw]
        bad = np.array([u in self.bad for u in raw], bool) if self.bad else np.zeros(len(raw), bool)
        flat = np.frombuffer(b"".join(found), np.uint32)
        count = np.fromiter(map(len, found), np.int64, len(found)) // 4
        code = coded.indices.to_numpy()
        first, size = (np.cumsum(count) - count)[code], count[code]
        ends = np.cumsum(size)
        place = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first - (ends - size), size)
        return flat[place], size, ~bad[code]

    def learn(self, new: list[bytes]) -> None:
        """Enter the ids of new units, and those among them whose ids have other bytes."""
        found = self.encode([u.decode() for u in new]) if new else []
        count = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(chain.from_iterable(found), np.uint32, int(count.sum()))
        ends = (4 * np.cumsum(count)).tolist()
        raw = ids.tobytes()
        self.known.update((u, raw[a:b]) for u, a, b in zip(new, [0, *ends], ends, strict=False))
        whole = np.concatenate([[0], np.cumsum(self.size[ids])])[np.concatenate([[0], np.cumsum(count)])]
        width = np.fromiter(map(len, new), np.int64, len(new))
        if not np.array_equal(np.diff(whole), width) or b"".join([self.tokens[i] for i in ids.tolist()]) != b"".join(new):
            self.bad.update(u for u, own in zip(new, found, strict=True) if b"".join([self.tokens[i] for i in own]) != u)
        self.held += int(width.sum())


class ByteLevel(Side):
    """Byte-level BPE from a tokenizer file; classes: as `character_classes` gives them."""

    def __init__(self, vocabulary: bytes, classes: np.ndarray):
        from tokenizers import Tokenizer

        spec = json.loads(vocabulary)
        cut = spec.get("pre_tokenizer") or {}
        if spec.get("normalizer") or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
            raise ValueError("the first vocabulary is no plain byte-level one")
        self.library = Tokenizer.from_str(vocabulary.decode())
        self.library.encode_special_tokens = True
        letters = {_byte_letter(byte): byte for byte in range(256)}
        entry = {i: t for t, i in spec["model"]["vocab"].items()}
        super().__init__([bytes(letters[c] for c in entry.get(i, "")) for i in range(max(entry) + 1)])
        self.classes = classes

    def encode(self, units: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(units, add_special_tokens=False)]

    def starts(self, texts: list[str], data: bytes, edges: np.ndarray) -> np.ndarray:
        return bpe.cut_starts(texts, self.classes)[1]


def character_classes() -> np.ndarray:
    """The class of every code point as the first library's patterns have it."""
    from tokenizers import Regex, pre_tokenizers

    out = np.zeros(0x110000, np.uint8)
    kinds = [(kind, pre_tokenizers.Split(Regex(pattern), "removed")) for kind, pattern in
             ((bpe.LETTER, r"\p{L}+"), (bpe.NUMBER, r"\p{N}+"), (bpe.SPACE, r"\s+"))]
    for start in range(0, len(out), 1 << 14):
        points = [c for c in range(start, min(start + (1 << 14), len(out))) if not 0xD800 <= c < 0xE000]
        some = "".join(map(chr, points))
        for kind, split in kinds if some else []:
            left = np.zeros(len(points), bool)
            for _, (a, b) in split.pre_tokenize_str(some):
                left[a:b] = True
            out[np.array(points)[~left]] = kind
    return out


def _byte_letter(byte: int) -> str:
    """The character that stands for a byte in a byte-level vocabulary: itself where printable, else the next from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return chr(byte) if byte in printable else chr(256 + sum(b not in printable for b in range(byte)))


class Pieces(Side):
    """Pieces with byte fallback from a sentence-piece model that puts a blank before a text."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        tokens = []
        for i in range(self.library.get_piece_size()):
            piece = self.library.id_to_piece(i)
            if self.library.is_control(i) or self.library.is_unknown(i):
                tokens.append(b"")
                continue
            if "▁" in piece.lstrip("▁"):
                raise ValueError("the second vocabulary has pieces that go on behind a word's end")
            tokens.append(bytes([int(piece[3:5], 16)]) if self.library.is_byte(i) else piece.replace("▁", " ").encode())
        super().__init__(tokens)
        self.blank = self.library.piece_to_id("▁")

    def encode(self, units: list[str]) -> list[list[int]]:
        found = self.library.encode([u[1:] for u in units], num_threads=1)
        return [ids if len(u) > 1 else [self.blank] for u, ids in zip(units, found, strict=True)]

    def starts(self, texts: list[str], data: bytes, edges: np.ndarray) -> np.ndarray:
        buf = np.frombuffer(data, np.uint8)
        start = buf == 0x20
        start[1:] &= buf[:-1] != 0x20
        start[edges[:-1][edges[:-1] < len(buf)]] = True
        return np.flatnonzero(start)


def terminals(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For both sides' token ends over the same bytes: the last token (a position in `b`) of each token's component."""
    n = len(a)
    succ = np.empty(n + len(b), np.int64)
    succ[:n] = n + np.searchsorted(b, a)
    cover = np.searchsorted(a, b)
    succ[n:] = np.where(a[cover] > b, cover, n + np.arange(len(b)))
    while True:
        then = succ[succ]
        if np.array_equal(then, succ):
            return succ[:n] - n, succ[n:] - n
        succ = then


def group_text(sides: tuple[Side, Side], ids: tuple[np.ndarray, np.ndarray], group: tuple[np.ndarray, np.ndarray], n_groups: int):
    """(bytes of `a1,a2|b1;...` with ';' behind every group, offset of each group in them)."""
    held = [np.bincount(g, minlength=n_groups) for g in group]
    before_a, before_b = np.cumsum(held[1]) - held[1], np.cumsum(held[0])
    place = np.arange(len(ids[0])) + before_a[group[0]], np.arange(len(ids[1])) + before_b[group[1]]
    size = np.empty(len(ids[0]) + len(ids[1]), np.int64)
    for side, i, p in zip(sides, ids, place, strict=True):
        size[p] = side.n_digits[i] + 1
    ends = np.cumsum(size)
    out = np.full(int(ends[-1]) if len(ends) else 0, ord(","), np.uint8)
    for side, i, p in zip(sides, ids, place, strict=True):
        start, n = ends[p] - size[p], side.n_digits[i]
        for k in range(side.digits.shape[1]):
            some = n > k
            out[start[some] + k] = side.digits[i[some], k]
    last_a = np.cumsum(held[0]) + before_a - 1
    last_b = np.cumsum(held[0] + held[1]) - 1
    out[ends[last_a] - 1], out[ends[last_b] - 1] = ord("|"), ord(";")
    return out.tobytes(), np.concatenate([[0], ends[last_b]])


def slices(texts: list[str], limit: int = SLICE_CHARS):
    """Lists of (row, blank and text) of about `limit` characters; a longer text is cut before a blank between words."""
    held, size = [], 0
    for row, text in enumerate(texts):
        at = 0
        while at < len(text):
            found = _CUT.search(text, at + limit) if at + limit < len(text) else None
            end = found.start() if found else len(text)
            held.append((row, text[at:end] if at else " " + text[:end]))
            size, at = size + end - at, end
            if size >= limit:
                yield held
                held, size = [], 0
    if held:
        yield held


class Aligned:
    """What the slices of a chunk add up to, by row."""

    def __init__(self, n: int):
        self.n = {c: np.zeros(n, np.int64) for c in ("n_a", "n_b", "n_groups", "n_links")}
        self.text = [hashlib.sha256() for _ in range(n)]
        self.good, self.begun = np.ones(n, bool), np.zeros(n, bool)
        self.links: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, some: list[tuple[int, str]], sides: tuple[Side, Side]) -> None:
        row, texts = np.array([r for r, _ in some]), [t for _, t in some]
        raw = [t.encode() for t in texts]
        data, edges = b"".join(raw), np.cumsum([0, *map(len, raw)])
        ids, doc, same = [], [], np.ones(len(some), bool)
        for side in sides:
            at = side.starts(texts, data, edges)
            found, count, equal = side.units(data, at)
            owner = np.searchsorted(edges, at, side="right") - 1
            same[owner[~equal]] = False
            ids.append(found.astype(np.int64)), doc.append(np.repeat(owner, count))
        self.good[row[~same]] = False
        for s in (0, 1):
            ids[s], doc[s] = (x[same[doc[s]]] for x in (ids[s], doc[s])) if not same.all() else (ids[s], doc[s])
        if not len(ids[0]):
            return
        ends = [np.cumsum(side.size[i]) for side, i in zip(sides, ids, strict=True)]
        last = terminals(*ends)
        root = np.zeros(len(ids[1]), bool)
        root[last[1]] = True
        number = np.cumsum(root) - 1
        n_groups = int(number[-1]) + 1
        text, group_ends = group_text(sides, tuple(ids), (number[last[0]], number[last[1]]), n_groups)
        in_doc = np.bincount(doc[1][root], minlength=len(some))
        first = np.cumsum(in_doc) - in_doc
        every = np.concatenate(ends)
        every.sort(kind="stable")
        every = every[np.concatenate([[True], every[1:] != every[:-1]])]
        a, b = (np.searchsorted(e, every) for e in ends)
        code, link_doc = ids[0][a] * len(sides[1].tokens) + ids[1][b], doc[0][a]
        for c, d in (("n_a", doc[0]), ("n_b", doc[1]), ("n_groups", doc[1][root]), ("n_links", link_doc)):
            np.add.at(self.n[c], row, np.bincount(d, minlength=len(some)))
        for i in np.flatnonzero(in_doc).tolist():
            r = row[i]
            self.text[r].update(b";" * int(self.begun[r]) + text[group_ends[first[i]]:group_ends[first[i] + in_doc[i]] - 1])
            self.begun[r] = True
        pairs, at = np.unique(code, return_inverse=True)
        key, times = np.unique(row[link_doc] * len(pairs) + at, return_counts=True)
        self.links.append((key // len(pairs), pairs[key % len(pairs)], times))

    def done(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, place of the pair, times) of each row's distinct pairs, by row, and the sorted pairs; rows without tokens lose theirs."""
        if not self.links:
            return (np.zeros(0, np.int64),) * 4
        row, code, times = (np.concatenate(x) for x in zip(*self.links, strict=True))
        row, code, times = (x[self.good[row]] for x in (row, code, times))
        for n in self.n.values():
            n[~self.good] = 0
        pairs, at = np.unique(code, return_inverse=True)
        if len(self.links) > 1 and len(row):
            key, of = np.unique(row * len(pairs) + at, return_inverse=True)
            times = np.bincount(of, weights=times).astype(np.int64)
            row, at = key // len(pairs), key % len(pairs)
        return row, at, times, pairs

    def digests(self) -> list[str]:
        return [h.hexdigest() if n else "" for h, n in zip(self.text, self.n["n_groups"], strict=True)]


def _packed(at: np.ndarray, times: np.ndarray) -> bytes:
    """Places and times of one row's pairs, places as steps."""
    return zlib.compress(np.concatenate([np.diff(at, prepend=0), times]).astype("<u4").tobytes(), 1) if len(at) else b""


def _unpacked(data: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(zlib.decompress(data), "<u4").astype(np.int64) if data else np.zeros(0, np.int64)
    return np.cumsum(both[:len(both) // 2]), both[len(both) // 2:]


_HELD: dict[str, tuple[Side, Side]] = {}


def _sides(key: str, held) -> tuple[Side, Side]:
    """The two sides of a broadcast, kept by a worker for its next tasks; key: a digest of the vocabularies."""
    if key not in _HELD:
        _HELD.clear()
        a, b, classes = held.value
        _HELD[key] = ByteLevel(a, classes), Pieces(b)
    return _HELD[key]


def linked(docs: DataFrame, a: bytes, b: bytes, keep_text: bool) -> tuple[DataFrame, DataFrame]:
    """(documents with their own counts, `chunk` and packed `links`; chunks with their sorted `pairs` and the documents that hold each)."""
    spark = docs.sparkSession
    arrowtext.bounded_batches(spark)
    held, key = spark.sparkContext.broadcast((a, b, character_classes())), hashlib.sha256(a + b).hexdigest()
    kept = [T.StructField(f.name, f.dataType) for f in docs.schema.fields if f.name not in ADDED and (keep_text or f.name != "text")]
    own = [*(T.StructField(c, T.LongType()) for c in ADDED[:4]), T.StructField("groups_sha256", T.StringType()),
           T.StructField("_chunk", T.StringType()), T.StructField("_links", T.BinaryType())]
    schema = T.StructType([*kept, *own, T.StructField("_pairs", T.BinaryType()), T.StructField("_docs", T.BinaryType())])

    def run(batches):
        sides = _sides(key, held)
        for number, part in enumerate(arrowtext.chunks(batches)):
            chunk, n = f"{TaskContext.get().partitionId()}-{number}", part.num_rows
            found = Aligned(n)
            for some in slices(arrowtext.texts(part.column("text"))):
                found.add(some, sides)
            row, at, times, pairs = found.done()
            cuts = np.searchsorted(row, np.arange(n + 1)).tolist()
            links = [_packed(at[x:y], times[x:y]) for x, y in zip(cuts, cuts[1:], strict=False)]
            out = [part.column(f.name) for f in kept] + [pa.array(found.n[c]) for c in ADDED[:4]]
            out += [pa.array(found.digests()), pa.array([chunk] * n), pa.array(links, pa.binary())]
            yield pa.RecordBatch.from_arrays([*out, pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())], schema.names)
            if len(pairs):
                last = [pa.nulls(1, c.type) for c in out]
                last[-2] = pa.array([chunk])
                holders = np.bincount(at, minlength=len(pairs)).astype("<u4").tobytes()
                yield pa.RecordBatch.from_arrays([*last, pa.array([pairs.astype("<i8").tobytes()], pa.binary()), pa.array([holders], pa.binary())],
                                                 schema.names)

    every = session.cut(docs.mapInArrow(run, schema))
    chunks = every.where(F.col("_pairs").isNotNull()).select("_chunk", "_pairs", "_docs")
    return every.where(F.col("_pairs").isNull()).drop("_pairs", "_docs"), chunks


def pair_counts(chunks: DataFrame, n_b: int) -> DataFrame:
    """(pair, n, best) over all chunks: documents that hold the pair, and whether no other pair of its first id has more."""
    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def summed():
            pairs, at = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
            return pairs, np.bincount(at, weights=np.concatenate([h[1] for h in held])).astype(np.int64)

        def sent():
            pairs, n = summed()
            for at in range(0, len(pairs), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(pairs[at:at + (1 << 16)]), pa.array(n[at:at + (1 << 16)])], ["pair", "n"])

        for batch in batches:
            for pairs, n in zip(batch.column("_pairs").to_pylist(), batch.column("_docs").to_pylist(), strict=True):
                held.append((np.frombuffer(pairs, "<i8"), np.frombuffer(n, "<u4").astype(np.int64)))
                if sum(len(h[0]) for h in held) > 2 * SUM_PAIRS:
                    held = [summed()]
                    if len(held[0][0]) > SUM_PAIRS:
                        yield from sent()
                        held = []
        if held:
            yield from sent()

    n = chunks.select("_pairs", "_docs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    n = session.cut(n.withColumn("a", F.expr(f"pair div {n_b}")))
    most = n.groupBy("a").agg(F.max("n").alias("most"))  # no more rows than the first vocabulary has ids
    return n.join(F.broadcast(most), "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align(docs: DataFrame, a: bytes, b: bytes, keep_text: bool = True) -> DataFrame:
    """`docs` with the ADDED columns; a: a byte-level tokenizer file, b: a piece model, both as `read_vocabulary` gives them."""
    own, chunks = linked(docs, a, b, keep_text)
    counts = pair_counts(chunks, len(Pieces(b).tokens))

    def spread(batches):
        for batch in batches:
            for chunk, pairs in zip(batch.column("_chunk").to_pylist(), batch.column("_pairs").to_pylist(), strict=True):
                found = np.frombuffer(pairs, "<i8")
                for at in range(0, len(found), 1 << 16):
                    some = found[at:at + (1 << 16)]
                    yield pa.RecordBatch.from_arrays([pa.array([chunk] * len(some), pa.string()), pa.array(some)], ["_chunk", "pair"])

    wanted = chunks.select("_chunk", "_pairs").mapInArrow(spread, "_chunk string, pair long").join(counts, "pair")
    fields = [f for f in own.schema.fields if f.name not in ("_chunk", "_links", "groups_sha256")]
    fields += [T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType()), own.schema["groups_sha256"]]
    names = [f.name for f in fields]

    def judge(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right.column("pair").to_numpy())
        n, best = right.column("n").to_numpy()[order], right.column("best").to_numpy()[order].astype(np.int64)
        of_best, total = [], []
        for links in left.column("_links").to_pylist():
            at, times = _unpacked(links)
            of_best.append(int((best[at] * times).sum())), total.append(int((n[at] * times).sum()))
        left = left.append_column("n_best", pa.array(of_best, pa.int64())).append_column("count_sum", pa.array(total, pa.int64()))
        return left.select(names)

    return own.groupBy("_chunk").cogroup(wanted.groupBy("_chunk")).applyInArrow(judge, T.StructType(fields))
