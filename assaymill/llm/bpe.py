"""Byte-level BPE encoding and decoding with DuckDB recursive queries, one small database per partition.

A text is cut by the vocabulary's pattern; each distinct word of a chunk becomes token-position rows. A recursive query
joins neighbouring rows with the merge table and contracts each word's leftmost pair of least rank until no pair is left.
The ids of a text are those of its words in turn; ordered aggregation over token positions decodes them.

Words of over LONG_WORD bytes go through a second recursive query that contracts, in one round, every occurrence of the least
pair that the one-at-a-time order would contract next anyway: all of them (leftmost first, not overlapping) if no token
made of the merged one and a neighbour has a lower rank, else the leftmost only. Both give the library's ids.

Null and empty texts have no ids. Broken UTF-8 is replaced before encoding. Rows are handled one by one, so repeated rows, ties
and extra columns need no rule; extra columns are kept, those named like an output column are replaced.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from assaymill.llm import arrowtext

#: Words of over this many bytes may contract several pairs in one round.
LONG_WORD = 48
#: A vocabulary file of more bytes than this is refused: the table travels to every executor.
MAX_VOCABULARY_BYTES = 64 << 20
#: Text bytes cut and looked up at once.
CHUNK_BYTES = 1 << 20
#: Rows of one encoding query, which holds those of all its rounds: n * n / 2 for a word of n bytes, if each round contracts one pair.
#: A word of more rows has a query of its own.
QUERY_ROWS = 1 << 20
#: Words whose ids a task keeps for its next chunks; a full cache starts anew.
CACHE_WORDS = 300_000

#: The split pattern that is also known as a rule over character classes (see `cut_starts`).
KNOWN_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: A row's `pair` is the rank of it and its successor, then its position: the least of a word is its leftmost pair of least
#: rank. Rows keep their order through the rounds (one thread, order-preserving joins); `error` stops the query if not.
_PAIRS = """
SELECT t.w, t.pos, t.id, (m.merged::BIGINT << 40) | t.pos AS pair, t.round FROM (
  SELECT w, pos, id, round, CASE WHEN lead(w) OVER () = w THEN
           CASE WHEN lead(pos) OVER () > pos THEN lead(id) OVER () ELSE error('rows lost their order') END END AS following
  FROM ({rows})) t
LEFT JOIN merges m ON m.pair_key = (t.id::BIGINT << 32) | t.following
"""

_LAST_ROUND = """
SELECT s.w, s.pos, s.id FROM state s
JOIN (SELECT w, max(round) AS round FROM state GROUP BY w) l ON l.w = s.w AND l.round = s.round ORDER BY s.w, s.pos
"""

_LEAST = "(SELECT w, min(pair) AS best FROM state GROUP BY w HAVING min(pair) IS NOT NULL)"

#: One contraction a round for each word: the row takes the merged id, its successor goes.
_ENCODE = f"""
WITH RECURSIVE state AS (
  {_PAIRS.format(rows="SELECT w, pos, id, 0 AS round FROM letters")}
  UNION ALL
  {_PAIRS.format(rows=f"""
    SELECT w, pos, id, round FROM (
      SELECT w, pos, CASE WHEN hit THEN (pair >> 40)::INTEGER ELSE id END AS id, lag(hit) OVER () AS gone, round FROM (
        SELECT s.w, s.pos, s.id, s.pair, coalesce(s.pair = b.best, FALSE) AS hit, s.round + 1 AS round
        FROM state s JOIN {_LEAST} b ON b.w = s.w)) WHERE gone IS NOT TRUE""")}
)
{_LAST_ROUND}
"""

#: As above, with all contractions of one rank at once where `lone` is false. In a run of overlapping pairs every second
#: one is taken, from the left.
_ENCODE_LONG = f"""
WITH RECURSIVE state AS (
  {_PAIRS.format(rows="SELECT w, pos, id, 0 AS round FROM letters")}
  UNION ALL
  {_PAIRS.format(rows=f"""
    SELECT w, pos, id, round FROM (
      SELECT w, pos, CASE WHEN taken THEN (pair >> 40)::INTEGER ELSE id END AS id,
             lag(taken) OVER (PARTITION BY w ORDER BY pos) AS gone, round
      FROM (
        SELECT *, hit AND (row_number() OVER (PARTITION BY w, hit, run ORDER BY pos)) % 2 = 1 AS taken
        FROM (
          SELECT *, row_number() OVER (PARTITION BY w ORDER BY pos)
                    - row_number() OVER (PARTITION BY w, hit ORDER BY pos) AS run
          FROM (
            SELECT s.w, s.pos, s.id, s.pair, s.round + 1 AS round,
                   coalesce(CASE WHEN l.lone THEN s.pair = b.best ELSE s.pair >> 40 = b.best >> 40 END, FALSE) AS hit
            FROM state s JOIN {_LEAST} b ON b.w = s.w JOIN lone l ON l.id = b.best >> 40))))
    WHERE gone IS NOT TRUE ORDER BY w, pos""")}
)
{_LAST_ROUND}
"""

#: Token bytes as text of one character per byte, so that they can be aggregated in order.
_DECODE = """
SELECT doc, string_agg(letters, '' ORDER BY pos) AS decoded
FROM (SELECT t.doc, t.pos, v.letters FROM tokens t JOIN vocabulary v ON v.id = t.id) GROUP BY doc ORDER BY doc
"""

#: The characters of the Unicode property White_Space.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

OTHER, LETTER, NUMBER, SPACE, EDGE = range(5)


def character_classes() -> np.ndarray:
    """The class of every code point: letter, number, white space or other."""
    import regex

    out = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, name in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}")):
        out[[ord(c) for c in regex.findall(name, every)]] = kind
    out[WHITE_SPACE] = SPACE
    return out


def cut_starts(texts: list[str], classes: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """KNOWN_PATTERN for many texts at once: (UTF-8 of all texts, byte offset of each match, number of matches of each text).

    The pattern's matches tile a text. They are runs of one class; the last white-space character before another run goes
    to it if it is a blank and is a match of its own if not; an apostrophe that starts a match takes its contraction.
    """
    code = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le"), np.uint32)
    size = np.array([len(t) for t in texts], np.int64)
    edge = np.cumsum(size + 1) - 1
    kind = classes[code]
    kind[edge] = EDGE
    width = np.ones(len(code), np.int64)
    for least in (0x80, 0x800, 0x10000):
        width += code >= least
    width[edge] = 0
    at = np.cumsum(width) - width
    start = np.ones(len(code), bool)
    start[1:] = kind[1:] != kind[:-1]
    follows = np.flatnonzero(start[1:] & (kind[:-1] == SPACE) & (kind[1:] != EDGE)) + 1
    start[follows - 1] = True
    start[follows] = code[follows - 1] != 0x20
    quote = np.flatnonzero((code == 0x27) & start)
    quote = quote[kind[quote + 1] == LETTER]
    one, two = code[quote + 1], code[np.minimum(quote + 2, len(code) - 1)]
    is_one = np.isin(one, [ord(c) for c in "stmd"])
    is_two = np.zeros(len(quote), bool)
    for a, b in ("re", "ve", "ll"):
        is_two |= (one == ord(a)) & (two == ord(b))
    for some, n in ((is_one, 1), (is_two, 2)):
        begin = quote[some]
        start[begin + 1] = False
        start[begin + 1 + n] = True
    start[edge] = False
    found = np.flatnonzero(start)
    return "".join(texts).encode(), at[found], np.diff(np.searchsorted(found, np.concatenate([[0], edge])))


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a rank file (base64 token, blank, rank on each line)."""
    with open(path, "rb") as f:
        data = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"vocabulary {path} has over {MAX_VOCABULARY_BYTES} bytes")
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}


class Codec:
    """A DuckDB database with the merge table and the vocabulary, and the queries over them."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import duckdb
        import regex

        self.ranks, self.find = ranks, regex.compile(pattern).findall
        self.classes = character_classes() if pattern == KNOWN_PATTERN else None
        self.cache: dict[bytes, bytes] = {}
        left, right, merged = [], [], []
        lowest: dict[int, int] = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), merged.append(rank)
                    lowest[a] = min(lowest.get(a, rank), rank)
                    lowest[b] = min(lowest.get(b, rank), rank)
        self.letter = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "500MB"})
        self.db.execute("SET disabled_optimizers = 'build_side_probe_side,join_order'")
        key = (np.array(left, np.int64) << 32) | np.array(right, np.int64)
        self._table("merges", pair_key=key, merged=np.array(merged, np.int32))
        ids = np.array(list(ranks.values()), np.int32)
        self._table("lone", id=ids, lone=np.array([lowest.get(int(i), 1 << 62) < i for i in ids]))
        self._table("vocabulary", id=ids, letters=[token.decode("latin-1") for token in ranks])

    def _table(self, name: str, **columns) -> None:
        self.db.register("incoming", pa.table(columns))
        self.db.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM incoming")
        self.db.unregister("incoming")

    def encode_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in turn, number of ids of each word) for distinct words."""
        raw = words.cast(pa.large_binary()).to_pylist()
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        new = [b for b in raw if b not in self.ranks and b not in self.cache]
        for some, query in (([b for b in new if len(b) <= LONG_WORD], _ENCODE), ([b for b in new if len(b) > LONG_WORD], _ENCODE_LONG)):
            rows, start, held = np.cumsum([len(b) * (len(b) + 1) // 2 for b in some]), 0, 0
            while start < len(some):
                end = max(start + 1, int(np.searchsorted(rows, held + QUERY_ROWS, side="right")))
                self._contract(some[start:end], query)
                held, start = int(rows[end - 1]), end
        found = [self.cache[b] if b in self.cache else np.int32(self.ranks[b]).tobytes() for b in raw]
        return np.frombuffer(b"".join(found), np.int32).astype(np.uint32), np.array([len(b) // 4 for b in found], np.int64)

    def _contract(self, raw: list[bytes], query: str) -> None:
        """The ids of the words, into the cache."""
        size = np.array([len(b) for b in raw])
        place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        self._table("letters", w=np.repeat(np.arange(len(raw), dtype=np.int32), size), pos=place.astype(np.int64),
                    id=self.letter[np.frombuffer(b"".join(raw), np.uint8)])
        got = self.db.execute(query).fetchnumpy()
        ids = np.asarray(got["id"], np.int32).tobytes()
        ends = np.searchsorted(np.asarray(got["w"]), np.arange(len(raw) + 1)).tolist()
        self.cache.update((b, ids[4 * ends[i]:4 * ends[i + 1]]) for i, b in enumerate(raw))

    def pieces(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """(all matches of the pattern in turn, number of matches of each text)."""
        if self.classes is None:
            found = [self.find(t) for t in texts]
            return pa.array([p for f in found for p in f], pa.large_string()), np.array([len(f) for f in found], np.int64)
        data, at, count = cut_starts(texts, self.classes)
        offs = np.append(at, len(data))
        return pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offs), pa.py_buffer(data)]), count

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in turn, offsets of the texts in them)."""
        pieces, n = self.pieces(texts)
        if not len(pieces):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        coded = pieces.dictionary_encode()
        ids, count = self.encode_words(coded.dictionary)
        code = coded.indices.to_numpy()
        first, size = (np.cumsum(count) - count)[code], count[code]
        ends = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(ends[-1]) + np.repeat(first - ends[:-1], size)
        return ids[at], ends[np.concatenate([[0], np.cumsum(n)])]

    def decode(self, ids: np.ndarray, offs: np.ndarray) -> list[bytes]:
        """The bytes of each text, by ordered aggregation of its tokens."""
        out = [b""] * (len(offs) - 1)
        if len(ids):
            size = np.diff(offs)
            self._table("tokens", doc=np.repeat(np.arange(len(size), dtype=np.int32), size),
                        pos=np.arange(len(ids), dtype=np.int64), id=ids.astype(np.int32))
            for doc, decoded in self.db.execute(_DECODE).fetchall():
                out[doc] = decoded.encode("latin-1")
        return out

    def close(self) -> None:
        """Gives the memory back: the process serves other tasks after this one."""
        self.cache.clear()
        self.db.close()
        pa.default_memory_pool().release_unused()


def with_tokens(docs: DataFrame, ranks: dict[bytes, int], pattern: str, keep_text: bool = True, keep_ids: bool = True,
                digests: bool = True) -> DataFrame:
    """`docs` with `ids` (array of int), `n_tokens`, and hashes of the ids and of what they decode to.

    keep_text / keep_ids: whether those columns leave the tasks. digests: whether to decode and hash.
    """
    spark = docs.sparkSession
    arrowtext.bounded_batches(spark)
    table = spark.sparkContext.broadcast((ranks, pattern))
    added = ["ids", "n_tokens", "ids_sha256", "decoded_sha256"]
    kept = [f for f in docs.schema.fields if f.name not in added and (keep_text or f.name != "text")]
    fields = kept + ([T.StructField("ids", T.ArrayType(T.IntegerType(), False))] if keep_ids else [])
    fields += [T.StructField("n_tokens", T.LongType())]
    fields += [T.StructField(c, T.StringType()) for c in added[2:]] if digests else []
    names = [f.name for f in kept]

    def run(batches):
        codec = Codec(*table.value)
        for part in arrowtext.chunks(batches, limit=CHUNK_BYTES):
            ids, offs = codec.encode(arrowtext.texts(part.column("text")))
            size = np.diff(offs)
            out = [part.column(c) for c in names]
            if keep_ids:
                out.append(pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(ids.astype(np.int32))))
            out.append(pa.array(size, pa.int64()))
            if digests:
                raw = ids.astype("<u4")
                out.append(pa.array([hashlib.sha256(raw[a:b].tobytes()).hexdigest() for a, b in zip(offs[:-1], offs[1:], strict=True)]))
                out.append(pa.array([hashlib.sha256(b).hexdigest() for b in codec.decode(ids, offs)]))
            yield pa.RecordBatch.from_arrays(out, [f.name for f in fields])
        codec.close()

    schema = T.StructType(fields)
    return docs.mapInArrow(run, schema)


def decode_ids(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """`docs` with a column `ids`, as `doc_id` and the `decoded` bytes; a null array decodes to no bytes, a null id is skipped.

    Ids outside the vocabulary are an error of the input and raise.
    """
    spark = docs.sparkSession
    arrowtext.bounded_batches(spark)
    table = spark.sparkContext.broadcast((ranks, pattern))

    def run(batches):
        codec = Codec(*table.value)
        top = max(codec.ranks.values())
        for part in batches:
            rows = [[i for i in (r or []) if i is not None] for r in part.column("ids").to_pylist()]
            flat = np.array([i for r in rows for i in r], np.int64)
            if len(flat) and (flat.min() < 0 or flat.max() > top):
                raise ValueError("a token id is not in the vocabulary")
            offs = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(codec.decode(flat, offs), pa.binary())],
                                             ["doc_id", "decoded"])

    return docs.select("doc_id", "ids").mapInArrow(
        run, T.StructType([docs.schema["doc_id"], T.StructField("decoded", T.BinaryType())]))
