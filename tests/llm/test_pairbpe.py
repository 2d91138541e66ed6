"""BPE by a pair occurrence index against the tokenizers library."""

import hashlib
import random

import pytest

from assaymill.llm import pairbpe, queries

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
SMALL = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    return pairbpe.Codec(pairbpe.read_vocabulary(PATH))


def encode(codec, text, **more):
    return [i for _, ids in codec.encode([text], **more) for i in ids.tolist()]


def odd_texts():
    rng = random.Random(5)
    letters = "ab 's'tl' re ve m ll d\n\t \xa0　123²éßÉ日!?'\x1c\x85 ٣ΣΌİ̈́ǅK"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    texts += ["", " ", "a", "!" * 3000, "aaaaaaa" * 77, "é" * 300, "ab" * 1500, "日本語" * 200, "\x1c!\x1c", "x<|endoftext|>y <|startoftext|><|startoftext|>'s",
              "<|endoftext", "".join(rng.choice("thenaiord") for _ in range(2500)), "word " * 5000, "ΑΣ ΟΔΟΣ!", "áḅ̇ ́x"]
    return texts


def test_codec_gives_the_librarys_ids(codec, library):
    for text in odd_texts():
        want = library.encode(text, add_special_tokens=False).ids
        got = encode(codec, text)
        assert got == want, repr(text[:60])
        assert codec.decode(pairbpe.np.array(got, int)).decode() == library.decode(want, skip_special_tokens=False)


def test_every_character(codec, library):
    chars = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    texts = [" ".join(f"a{c}1{c}'s{c}b ́{c}́" for c in chars[i:i + 256]) for i in range(0, len(chars), 256)]
    want = library.encode_batch(texts, add_special_tokens=False)
    for text, w in zip(texts, want, strict=True):
        assert encode(codec, text) == w.ids


def test_slices_and_a_full_cache_change_nothing(codec, library, monkeypatch):
    text = "".join(random.Random(2).choice("ab c\n") for _ in range(5000))
    want = library.encode(text, add_special_tokens=False).ids
    monkeypatch.setattr(pairbpe, "CACHE_CHARS", 3)
    for limit in (1, 7, 100, 4999, 10000):
        assert encode(codec, text, limit=limit) == want
    rows = [(r, t) for some in pairbpe.slices(["ab cd", "", "efghij k", "l"], 3) for r, t in some]
    assert [("".join(t for r, t in rows if r == i)) for i in range(4)] == ["ab cd", "", "efghij k", "l"]


def test_the_library_splits_alike_without_the_shorter_way(codec, library):
    slow = pairbpe.Codec(pairbpe.read_vocabulary(PATH))
    assert codec.plain
    slow.plain = False
    for text in ["It's 12 o'clock, they'll've A_b--'s\x01\x7f<|endoftext|>'dd", *odd_texts()[:300]]:
        assert encode(slow, text) == encode(codec, text) == library.encode(text, add_special_tokens=False).ids


def test_a_long_word_takes_no_quadratic_time(codec, library):
    text = "".join(random.Random(4).choice("abcdefghijklmnopqrstuvwxyz") for _ in range(200_000))
    assert encode(codec, text) == library.encode(text, add_special_tokens=False).ids


def test_merges_out_of_order_are_refused():
    vocab = {"a": 0, "b": 1, "ab": 2, "aba": 3}
    with pytest.raises(ValueError):
        pairbpe.Merges({"vocab": vocab | {"c": 4, "abc": 5}, "merges": [["a", "b"], ["a", "b"]]})
    merges = pairbpe.Merges({"vocab": vocab, "merges": [["a", "b"], ["ab", "a"]]})
    symbol, size = merges.symbols(["ababa", "", "bza"])
    assert (symbol.tolist(), size.tolist()) == ([0, 1, 0, 1, 0, -1, -1, 1, 0, -1], [6, 1, 3])
    assert [i for i in merges.contract(symbol).tolist() if i != pairbpe.GONE] == [2, 3, -1, -1, 1, 0, -1]


def test_query_on_the_small_table(spark, library):
    got = {r["doc_id"]: r for r in queries.QUERIES["op13_pair_index_bpe"](spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d["text"] or "", add_special_tokens=False).ids
        r = got[d["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_nulls_repeats_and_clashing_columns(spark, library):
    vocabulary = pairbpe.read_vocabulary(PATH)
    rows = [(1, None, 5), (None, "", 6), (2, "a b", 7), (2, "a b", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = pairbpe.with_tokens(docs, vocabulary).collect()
    assert sorted(r["n_tokens"] for r in got) == [0, 0, 2, 2]
    assert all(r["ids"] == library.encode(r["text"] or "", add_special_tokens=False).ids for r in got)
    assert pairbpe.with_tokens(docs.limit(0), vocabulary).count() == 0
    back = pairbpe.decode_ids(spark.createDataFrame([(1, [320, None, 49407]), (2, None)], "doc_id long, ids array<int>"), vocabulary)
    assert {r["doc_id"]: r["decoded"] for r in back.collect()} == {1: library.decode([320, 49407], skip_special_tokens=False), 2: ""}
