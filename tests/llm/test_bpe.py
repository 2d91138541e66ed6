"""Byte-level BPE against the tiktoken library."""

import hashlib
import random

import pytest

from assaymill.llm import bpe, queries

tiktoken = pytest.importorskip("tiktoken")
public_tokenizers = pytest.importorskip("public_tokenizers")
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def vocabulary():
    return queries.vocabulary()


@pytest.fixture(scope="module")
def library(vocabulary):
    ranks, pattern = vocabulary
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def digest(ids):
    return hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()


def odd_texts():
    rng = random.Random(3)
    letters = "ab 's'tl' re ve m ll d\n\t \xa0　123²éß日!?'\x1c\x85 ٣"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += ["", " ", "a", "!" * 3000, "=" * 777, "é" * 300, "ab" * 1500, "日本語" * 200,
              "".join(rng.choice("thenaiord") for _ in range(2500)), "x <|endoftext|> y", "word " * 5000]
    return texts


def test_codec_gives_the_librarys_ids(vocabulary, library):
    codec, texts = bpe.Codec(*vocabulary), odd_texts()
    ids, offs = codec.encode(texts)
    decoded = codec.decode(ids, offs)
    for i, t in enumerate(texts):
        assert ids[offs[i]:offs[i + 1]].tolist() == library.encode_ordinary(t), repr(t[:60])
        assert decoded[i] == t.encode()


def test_other_patterns_use_the_pattern_itself(vocabulary):
    ranks, _ = vocabulary
    pattern = r"\S+|\s+"
    ids, _ = bpe.Codec(ranks, pattern).encode(["hello  world's"])
    other = tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    assert ids.tolist() == other.encode_ordinary("hello  world's")


def test_cache_starts_anew_when_full(vocabulary, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 5)
    codec = bpe.Codec(*vocabulary)
    for t in ("qwzx vbnq plmk ztrw", "hjkq wqzv ghtr xxqz", "qwzx vbnq plmk ztrw"):
        assert codec.encode([t])[0].tolist() == library.encode_ordinary(t)


def test_a_query_holds_no_more_rows_than_allowed(vocabulary, library, monkeypatch):
    """Rounds of a whole chunk's words stood in memory at once."""
    sizes = []
    contract = bpe.Codec._contract
    monkeypatch.setattr(bpe, "QUERY_ROWS", 500)
    monkeypatch.setattr(bpe.Codec, "_contract", lambda self, raw, query: (sizes.append([len(b) for b in raw]), contract(self, raw, query))[1])
    rng = random.Random(4)
    text = " ".join("".join(rng.choice("qzxvkwjab") for _ in range(rng.choice([3, 9, 15, 40, 70]))) for _ in range(400))
    codec = bpe.Codec(*vocabulary)
    assert codec.encode([text])[0].tolist() == library.encode_ordinary(text)
    assert len(sizes) > 100 and all(len(s) == 1 or sum(n * (n + 1) // 2 for n in s) <= 500 for s in sizes)
    codec.close()


def test_query_on_the_small_table(spark, library):
    got = {r["doc_id"]: r for r in queries.QUERIES["op2_byte_bpe"](spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode_ordinary(d["text"] or "")
        r = got[d["doc_id"]]
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), digest(ids))
        assert r["decoded_sha256"] == hashlib.sha256((d["text"] or "").encode()).hexdigest()


def test_nulls_repeats_and_clashing_columns(spark, vocabulary, library):
    rows = [(1, None, 5), (None, "", 6), (2, "a b", 7), (2, "a b", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = bpe.with_tokens(docs, *vocabulary).collect()
    assert sorted(r["n_tokens"] for r in got) == [0, 0, 2, 2]
    assert all(r["ids"] == library.encode_ordinary(r["text"] or "") for r in got)
    assert bpe.with_tokens(docs.limit(0), *vocabulary).count() == 0
    back = bpe.decode_ids(spark.createDataFrame([(1, [64, None, 65]), (2, None)], "doc_id long, ids array<int>"), *vocabulary)
    assert {r["doc_id"]: bytes(r["decoded"]).decode() for r in back.collect()} == {1: library.decode([64, 65]), 2: ""}
