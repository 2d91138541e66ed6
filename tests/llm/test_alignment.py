"""Alignment of two tokenizers against a scan over byte offsets with the libraries' tokens."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from assaymill.llm import alignment, queries

tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
public_tokenizers = pytest.importorskip("public_tokenizers")
SMALL = "/root/testdata/sf0.001"
A, B = (alignment.read_vocabulary(public_tokenizers.path(n)) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def libraries():
    a = tokenizers.Tokenizer.from_str(A.decode())
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_proto=B)


@pytest.fixture(scope="module")
def sides():
    return alignment.ByteLevel(A, alignment.character_classes()), alignment.Pieces(B)


def tokens(libraries, sides, text):
    """(ids, byte ranges) of both sides; None if the text has no tokens."""
    if not text:
        return None
    out, data = [], (" " + text).encode()
    for ids, side in ((libraries[0].encode(" " + text, add_special_tokens=False).ids, sides[0]), (libraries[1].encode(text), sides[1])):
        raw = [side.tokens[i] for i in ids]
        if b"".join(raw) != data:
            return None
        ends = np.cumsum([len(r) for r in raw]).tolist()
        out.append((ids, list(zip([0, *ends], ends))))
    return out


def brute(libraries, sides, texts):
    found, held = [], Counter()
    for text in texts:
        both = tokens(libraries, sides, text)
        if both is None:
            found.append((0, 0, 0, "", []))
            continue
        (a, ra), (b, rb) = both
        links, j = [], 0
        for i, (s, e) in enumerate(ra):
            while rb[j][1] <= s:
                j += 1
            k = j
            while k < len(rb) and rb[k][0] < e:
                links.append((a[i], b[k]))
                k += 1
        cuts = sorted({e for _, e in ra} & {e for _, e in rb})
        groups, i, j = [], 0, 0
        for cut in cuts:
            x, y = i, j
            while i < len(a) and ra[i][1] <= cut:
                i += 1
            while j < len(b) and rb[j][1] <= cut:
                j += 1
            groups.append(",".join(map(str, a[x:i])) + "|" + ",".join(map(str, b[y:j])))
        held.update(set(links))
        found.append((len(a), len(b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest(), links))
    most = {}
    for (x, _), n in held.items():
        most[x] = max(most.get(x, 0), n)
    return [(na, nb, ng, len(ls), sum(held[p] == most[p[0]] for p in ls), sum(held[p] for p in ls), sha) for na, nb, ng, sha, ls in found]


def odd_texts():
    rng = random.Random(8)
    letters = "ab 's'tl' re ve m \n\t \xa0\u3000123²éßÉ日!?\x1c\x85\u0663\u200b\ufeff\x00Ⅷ😀"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(600)]
    texts += [None, "", " ", "  ", "   a", "a ", "a  ", "\u2581", "a\u2581b", "<s> </s> <unk> <|endoftext|> <0x41>", "日本語" * 200, "ab" * 1500, "e\u0301 ﬁ Å",
              "".join(rng.choice("thenaiord") for _ in range(2500)), "word " * 3000, "internationalization of antidisestablishmentarianism"]
    return texts


def columns(rows):
    return [tuple(r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")) for r in rows]


def test_units_give_the_libraries_ids(libraries, sides):
    for text in odd_texts():
        if text:
            data = (" " + text).encode()
            edges = np.array([0, len(data)])
            for side, want in ((sides[0], libraries[0].encode(" " + text, add_special_tokens=False).ids), (sides[1], libraries[1].encode(text))):
                got = side.units(data, side.starts([" " + text], data, edges))[0].tolist()
                assert got == want or "\u2581" in text, repr(text)


def test_every_character(libraries, sides):
    chars = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000 and c != 0x2581]
    for i in range(0, len(chars), 2048):
        text = "".join(f"a{c}{c}1{c} {c}b" for c in chars[i:i + 2048])
        data = (" " + text).encode()
        for side, want in ((sides[0], libraries[0].encode(" " + text, add_special_tokens=False).ids), (sides[1], libraries[1].encode(text))):
            assert side.units(data, side.starts([" " + text], data, np.array([0, len(data)])))[0].tolist() == want


def test_pointer_jumping_over_long_chains():
    a, b = np.arange(2, 4001, 2), np.append(np.arange(3, 4000, 2), 4000)  # ends meet at the last byte only
    last = alignment.terminals(a, b)
    assert set(last[0].tolist()) == set(last[1].tolist()) == {len(b) - 1}


def test_slices_change_nothing(libraries, sides):
    text = " ".join(random.Random(1).choice(["the", "of", "tokenizer", "x", "\n", "éa", " "]) for _ in range(800))
    want = brute(libraries, sides, [text])[0]
    for limit in (5, 64, 1000, 10000):
        found = alignment.Aligned(1)
        for some in alignment.slices([text], limit):
            found.add(some, sides)
        row, at, times, pairs = found.done()
        assert (found.n["n_a"][0], found.n["n_b"][0], found.n["n_groups"][0], found.n["n_links"][0], found.digests()[0]) == (*want[:4], want[6])
        assert times.sum() == want[3] and len(pairs) == len(at) == len(row)


def test_operator(spark, libraries, sides):
    texts = odd_texts() + ["repeated text"] * 5
    docs = spark.createDataFrame([(i, t, "own") for i, t in enumerate(texts)], "doc_id long, text string, n_best string").repartition(5)
    got = sorted(alignment.align(docs, A, B).collect(), key=lambda r: r["doc_id"])
    assert [r["text"] for r in got] == texts
    assert columns(got) == brute(libraries, sides, texts)


def test_ids_null_or_repeated_and_empty_tables(spark, libraries, sides):
    rows = [(None, "a b"), (1, "a b"), (1, "a b"), (1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(columns(alignment.align(docs, A, B).collect())) == sorted(brute(libraries, sides, [t for _, t in rows]))
    assert alignment.align(docs.limit(0), A, B).count() == 0
    assert columns(alignment.align(docs.where("text is null"), A, B).collect()) == [(0, 0, 0, 0, 0, 0, "")]


def test_query_on_the_small_table(spark, libraries, sides):
    got = {r["doc_id"]: r for r in queries.QUERIES["op12_pointer_jumping"](spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    want = brute(libraries, sides, [d["text"] for d in docs])
    assert columns([got[d["doc_id"]] for d in docs]) == want
