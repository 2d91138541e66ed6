"""BPE encoding and decoding with a pair occurrence index over the words of a partition.

A text is cut at white space; each distinct raw word of a chunk goes through the vocabulary's own normaliser and splitter once, which
gives pieces. The new pieces of a chunk are laid out as one row of symbols. An index maps every mergeable pair, known by its
rank, to all its positions in that row. Active ranks are applied in ascending order, each from left to right at all its
positions; a merge takes its two neighbours' pairs off (they no longer hold when their turn comes) and enters the two new ones.
A merge can only make pairs of higher rank (checked when the vocabulary is read), so this order gives each piece what merging it alone would.

Ids of words are kept for the next chunks of a task. Strings of special tokens in a raw text are their ids, as in the library.
Decoding joins the entries of the ids by one blank, as the library does for a vocabulary that names no decoder.

Null and empty texts have no ids. Broken UTF-8 is replaced. Very long texts are worked on in slices that end before white space, so memory is
bounded by the longest run without any. Rows are handled one by one, so repeated rows and ties need no rule; extra
columns are kept, those named like an output column are replaced.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from assaymill.llm import arrowtext

#: A vocabulary file of more bytes than this is refused: it travels to every executor.
MAX_VOCABULARY_BYTES = 64 << 20
#: Characters of text whose words are laid out together.
SLICE_CHARS = 4 << 20
#: Characters of the words whose ids a task keeps; a full cache starts anew.
CACHE_CHARS = 4 << 20

#: The characters of the Unicode property White_Space.
BLANKS = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_WORD = re.compile(f"[^{BLANKS}]+")
#: The splitting of the vocabulary that has a shorter way for words of printable ASCII characters.
KNOWN_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_PLAIN, _PLAIN_PIECE = re.compile("[!-~]+"), re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
_BLANK = re.compile(f"[{BLANKS}]")

ADDED = ["ids", "n_tokens", "ids_sha256", "decoded_sha256"]


def read_vocabulary(path: str) -> str:
    """The text of a tokenizer file, checked for what this codec expects."""
    with open(path, encoding="utf-8") as f:
        text = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(text) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"vocabulary {path} has over {MAX_VOCABULARY_BYTES} characters")
    spec = json.loads(text)
    model = spec["model"]
    unused = ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges")
    if model["type"] != "BPE" or any(model.get(k) for k in unused) or spec.get("decoder") or spec.get("post_processor"):
        raise ValueError(f"vocabulary {path} is no plain BPE")
    if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
        raise ValueError(f"vocabulary {path} has added tokens that are not matched as they are")
    Merges(model)
    return text


class Merges:
    """`rank` of a pair of ids, what each rank makes, and the ids of single characters (with the suffix at a piece's end)."""

    def __init__(self, model: dict):
        vocabulary = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.parts: list[tuple[int, int, int]] = []
        born: dict[int, int] = {}
        for merge in model["merges"]:
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b, made = vocabulary[left], vocabulary[right], vocabulary[left + right]
            rank = len(self.parts)
            if max(born.get(a, -1), born.get(b, -1)) >= rank or born.setdefault(made, rank) != rank:
                raise ValueError(f"merge {rank} stands before a merge that makes one of its parts, or makes a token anew")
            self.parts.append((a, b, made))
        inner = {t: i for t, i in vocabulary.items() if len(t) == 1}
        last = {t[0]: i for t, i in vocabulary.items() if t[1:] == self.suffix and len(t) == 1 + len(self.suffix)}
        self.inner, self.last = (self._table(t, max(map(ord, [*inner, *last]))) for t in (inner, last))
        keys = np.array([(a << 32) | b for a, b, _ in self.parts], np.int64)
        self.key_ranks = np.argsort(keys)
        self.keys = keys[self.key_ranks]

    @staticmethod
    def _table(ids: dict[str, int], top: int) -> np.ndarray:
        """The id of each code point up to `top`; the last entry stands for all above."""
        table = np.full(top + 2, MISSING, np.int32)
        for c, i in ids.items():
            table[ord(c)] = i
        return table

    def symbols(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces' characters, each piece followed by EDGE; length of each piece with its EDGE).

        Characters without an entry fall away, as in the library.
        """
        size = np.array([len(p) for p in pieces], np.int64) + 1
        code = np.frombuffer("\0".join([*pieces, ""]).encode("utf-32-le"), np.uint32)
        edge = np.cumsum(size) - 1
        ids = _lookup(self.inner, code)
        ends = edge[size > 1] - 1
        ids[ends] = _lookup(self.last, code[ends])
        ids[edge] = EDGE
        kept = ids != MISSING
        return ids[kept], np.add.reduceat(kept.astype(np.int64), np.cumsum(size) - size) if len(size) else size

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, or -1."""
        key = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.key_ranks[at], -1)

    def contract(self, symbol: np.ndarray) -> np.ndarray:
        """`symbol` after all merges; what a merge took away is GONE."""
        n = len(symbol)
        symbol = symbol.copy()
        following, previous = np.arange(1, n + 1), np.arange(-1, n - 1)
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(rank: np.ndarray, place: np.ndarray) -> None:
            order = np.argsort(rank, kind="stable")
            rank, place = rank[order], place[order]
            cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            for r, some in zip(rank[np.concatenate([[0], cuts])].tolist(), np.split(place, cuts), strict=True):
                if r in index:
                    index[r].append(some)
                else:
                    index[r] = [some]
                    heapq.heappush(active, r)

        rank = self.ranks(symbol[:-1], symbol[1:])
        place = np.flatnonzero(rank >= 0)
        if len(place):
            enter(rank[place], place)
        while active:
            rank = heapq.heappop(active)
            a, b, made = self.parts[rank]
            entered = index.pop(rank)
            place = entered[0] if len(entered) == 1 else np.concatenate(entered)
            if len(place) > 1:
                place = np.unique(place)
            after = following[place]
            holds = (symbol[place] == a) & (symbol[after] == b)
            if a == b or not holds.all():
                place = place[holds]
                if a == b:
                    place = _leftmost(place, following)
                after = following[place]
            if not len(place):
                continue
            symbol[place], symbol[after] = made, GONE
            then = following[place] = following[after]
            previous[then] = place
            before = previous[place]
            before = before[before >= 0]
            left = np.concatenate([place, before])
            rank = self.ranks(symbol[left], symbol[following[left]])
            some = rank >= 0
            if some.any():
                enter(rank[some], left[some])
        return symbol


#: In rows of symbols: behind a piece, a character without an entry, and what a merge took away.
EDGE, MISSING, GONE = -1, -2, -3


def _lookup(table: np.ndarray, code: np.ndarray) -> np.ndarray:
    return table[np.minimum(code, len(table) - 1)]


def _leftmost(place: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Of the ascending places of a pair of equal parts those that are merged: in a run of overlapping ones every second."""
    joined = np.concatenate([[False], following[place[:-1]] == place[1:]])
    at = np.arange(len(place))
    return place[(at - np.maximum.accumulate(np.where(joined, 0, at))) % 2 == 0]


def slices(texts: list[str], limit: int):
    """Lists of (row, text) of about `limit` characters in all; a longer text is cut before white space."""
    held, size = [], 0
    for row, text in enumerate(texts):
        at = 0
        while at < len(text):
            end = at + limit - size
            if end < len(text):
                blank = _BLANK.search(text, max(end, at + 1))
                end = blank.start() if blank else len(text)
            held.append((row, text[at:end] if at or end < len(text) else text))
            size, at = size + min(end, len(text)) - at, min(end, len(text))
            if size >= limit:
                yield held
                held, size = [], 0
    if held:
        yield held


def _is_known(spec: dict) -> bool:
    """Whether a word of printable ASCII characters is normalised and split as _PLAIN_PIECE does on its lower case."""
    steps = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
    cut = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return (steps == ["NFC", "Replace", "Lowercase"] and spec["normalizer"]["normalizers"][1]["pattern"] == {"Regex": "\\s+"}
            and len(cut) == 2 and cut[0]["type"] == "Split" and cut[0]["pattern"] == {"Regex": KNOWN_SPLIT} and cut[0]["invert"]
            and cut[0]["behavior"] == "Removed" and cut[1]["type"] == "ByteLevel" and not cut[1]["add_prefix_space"] and not cut[1]["use_regex"])


class Codec:
    """Encodes and decodes with one vocabulary; lives in a task."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        spec = json.loads(vocabulary)
        library = Tokenizer.from_str(vocabulary)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        self.merges = Merges(spec["model"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.marks = re.compile(f"({'|'.join(map(re.escape, longest_first))})") if longest_first else None
        entry = {i: t for t, i in spec["model"]["vocab"].items()} | {i: t for t, i in self.special.items()}
        self.entries = [entry.get(i, "").encode() for i in range(max(entry) + 1)]
        self.plain = _is_known(spec)
        self.words: dict[str, bytes] = {}
        self.held = 0

    def split(self, words: list[str]) -> tuple[list[str], np.ndarray]:
        """(the pieces of all words in turn, number of pieces of each); no word has white space or a special token's string."""
        if self.plain:
            # Printable ASCII: lower-cased characters are their own normal form and byte symbols.
            found = [_PLAIN_PIECE.findall(w.lower()) if _PLAIN.fullmatch(w) else None for w in words]
        else:
            found = [None] * len(words)
        rest = [i for i, f in enumerate(found) if f is None]
        normal = self.normalizer.normalize_str(" ".join([words[i] for i in rest])) if self.normalizer else " ".join([words[i] for i in rest])
        for i, w in zip(rest, normal.split(" ") if rest else [], strict=True):
            found[i] = [p for p, _ in self.splitter.pre_tokenize_str(w)]
        return [p for f in found for p in f], np.array([len(f) for f in found], np.int64)

    def learn(self, words: set[str]) -> None:
        """Enter the ids of new raw words: one index over their distinct pieces."""
        self.held += sum(map(len, words))
        whole, marked = list(words), []
        if self.marks:
            marked = [w for w in whole if self.marks.search(w)]
            whole = [w for w in whole if not self.marks.search(w)] if marked else whole
        inner = [p for w in marked for p in self.marks.split(w) if p and p not in self.special]
        pieces, count = self.split([*whole, *inner])
        distinct = list(dict.fromkeys(pieces))
        symbol, size = self.merges.symbols(distinct)
        merged = self.merges.contract(symbol)
        kept = merged >= 0
        left = np.add.reduceat(kept, np.cumsum(size) - size, dtype=np.int64) if len(size) else size
        ids, ends = merged[kept].astype("<u4").tobytes(), (4 * np.cumsum(left)).tolist()
        known = {p: ids[a:b] for p, a, b in zip(distinct, [0, *ends], ends, strict=False)}
        ends = np.cumsum(count).tolist()
        coded = [b"".join([known[p] for p in pieces[a:b]]) for a, b in zip([0, *ends], ends, strict=False)]
        self.words.update(zip(whole, coded, strict=False))
        parts = iter(coded[len(whole):])
        for w in marked:
            self.words[w] = b"".join([np.array([self.special[p]], "<u4").tobytes() if p in self.special else next(parts)
                                      for p in self.marks.split(w) if p])

    def encode(self, texts: list[str], limit: int = SLICE_CHARS):
        """(row, ids) in text order; a row of a long text comes in several parts, an empty one in none."""
        for some in slices(texts, limit):
            found = [(row, _WORD.findall(text)) for row, text in some]
            new = {w for _, words in found for w in words}.difference(self.words)
            if self.held > CACHE_CHARS and new:  # a full cache starts anew, so all words of this slice are new
                self.words.clear()
                self.held, new = 0, {w for _, words in found for w in words}
            if new:
                self.learn(new)
            known = self.words
            for row, words in found:
                yield row, np.frombuffer(b"".join([known[w] for w in words]), "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        return b" ".join(map(self.entries.__getitem__, ids.tolist()))


def with_tokens(docs: DataFrame, vocabulary: str, keep_text: bool = True, keep_ids: bool = True, digests: bool = True) -> DataFrame:
    """`docs` with `ids` (array of int), `n_tokens`, and hashes of the ids and of what they decode to.

    vocabulary: as `read_vocabulary` gives it. keep_text / keep_ids: whether those columns leave the tasks. digests: whether to decode and hash.
    """
    spark = docs.sparkSession
    arrowtext.bounded_batches(spark)
    held = spark.sparkContext.broadcast(vocabulary)
    kept = [f for f in docs.schema.fields if f.name not in ADDED and (keep_text or f.name != "text")]
    fields = kept + ([T.StructField("ids", T.ArrayType(T.IntegerType(), False))] if keep_ids else [])
    fields += [T.StructField("n_tokens", T.LongType())] + ([T.StructField(c, T.StringType()) for c in ADDED[2:]] if digests else [])
    names = [f.name for f in fields]

    def run(batches):
        codec = Codec(held.value)
        for part in arrowtext.chunks(batches):
            n = part.num_rows
            count, ids = [0] * n, [[] for _ in range(n)]
            raw, decoded = [hashlib.sha256() for _ in range(n)], [hashlib.sha256() for _ in range(n)]
            for row, found in codec.encode(arrowtext.texts(part.column("text"))):
                if digests and len(found):
                    raw[row].update(found.tobytes())
                    decoded[row].update(b" " * bool(count[row]) + codec.decode(found))
                count[row] += len(found)
                if keep_ids:
                    ids[row].append(found.astype(np.int32))
            out = [part.column(f.name) for f in kept]
            if keep_ids:
                flat = np.concatenate([x for row in ids for x in row] or [np.zeros(0, np.int32)])
                out.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count)]), pa.int32()), pa.array(flat, pa.int32())))
            out.append(pa.array(count, pa.int64()))
            if digests:
                out += [pa.array([h.hexdigest() for h in raw]), pa.array([h.hexdigest() for h in decoded])]
            yield pa.RecordBatch.from_arrays(out, names)

    return docs.mapInArrow(run, T.StructType(fields))


def decode_ids(docs: DataFrame, vocabulary: str) -> DataFrame:
    """`docs` with a column `ids`, as `doc_id` and the `decoded` text; a null array decodes to no text, a null id is skipped.

    Ids outside the vocabulary are an error of the input and raise.
    """
    spark = docs.sparkSession
    arrowtext.bounded_batches(spark)
    held = spark.sparkContext.broadcast(vocabulary)

    def run(batches):
        codec = Codec(held.value)
        for part in batches:
            rows = [np.array([i for i in (r or []) if i is not None], np.int64) for r in part.column("ids").to_pylist()]
            if any(len(r) and (r.min() < 0 or r.max() >= len(codec.entries)) for r in rows):
                raise ValueError("a token id is not in the vocabulary")
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([codec.decode(r).decode() for r in rows], pa.string())],
                                             ["doc_id", "decoded"])

    return docs.select("doc_id", "ids").mapInArrow(run, T.StructType([docs.schema["doc_id"], T.StructField("decoded", T.StringType())]))
