"""Ranked lexical search against scoring every document for every item."""

import math
import random
import re
from collections import Counter

import pytest

from assaymill.llm import lexical

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    tf = [(d, Counter(words(t))) for d, t in docs]
    some = [c for _, c in tf if c]
    n_docs, n_terms, df = len(some), sum(sum(c.values()) for c in some), Counter(t for c in some for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in tf:
            if c:
                m = 100 - 75 + (75 * sum(c.values()) * n_docs) // n_terms
                s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in words(text) if c[t])
                if s > 0:
                    scores.append((-s, d is None, d or 0))
        out += [(item, rank, None if none else d, -s) for rank, (s, none, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def corpus(n=400, seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["Été", "日本", "x1", "THE"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    docs = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.choice([1, 5, 40, 300])))) for i in range(n)]
    docs += [(n + i, docs[3][1]) for i in range(60)] + [(7, docs[7][1]), (None, docs[3][1]), (n + 100, None), (n + 101, ""), (n + 102, "...")]
    items = [(i, " ".join(rng.choices(vocabulary, k=12))) for i in range(8)]
    items += [(8, docs[3][1]), (8, "été w1 W1 w1"), (9, None), (10, "unknown only"), (11, "!!"), (None, "日本 the the")]
    return docs, items


def rows(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("block_chars", [1 << 20, 60])
def test_search_is_the_full_ranking(spark, block_chars, monkeypatch):
    monkeypatch.setattr(lexical, "SLICE", 16)
    docs, items = corpus()
    d = spark.createDataFrame([(i, t, "own") for i, t in docs], "doc_id long, text string, score string").repartition(3)
    got = rows(lexical.search(d, spark.createDataFrame(items, "item_id long, text string"), block_chars=block_chars))
    assert got == brute(docs, items)


def test_other_k_and_text_ids(spark):
    docs, items = corpus(60, 2)
    d = spark.createDataFrame([(None if i is None else f"{i:05d}", t) for i, t in docs], "doc_id string, text string")
    got = lexical.search(d, spark.createDataFrame(items, "item_id long, text string"), k=3).collect()
    want = [(a, b, None if c is None else f"{c:05d}", s) for a, b, c, s in brute(docs, items, 3)]
    assert sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got), key=str) == sorted(want, key=str)


def test_long_text_in_slices(spark):
    text = " ".join(f"w{i % 50}" for i in range(3000))
    buf = lexical.np.frombuffer(text.encode(), lexical.np.uint8)
    parts = [bytes(b) for b, _ in lexical.slices(buf, lexical.np.array([0, len(buf)]), 100)]
    assert b"".join(parts) == text.encode() and len(parts) > 50 and all(p[:1] == b" " for p in parts[1:])
    terms = lexical.Terms([b"w1", b"w49", b"zz"])
    whole = lexical.counted(buf, lexical.np.array([0, len(buf)]), terms)
    assert [x.tolist() for x in whole] == [[3000], [0, 0], [0, 1], [60, 60]]


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.search(docs.limit(0), items).count() == 0
    assert lexical.search(docs, items.limit(0)).count() == 0
    assert rows(lexical.search(docs, items)) == brute([(1, "a b")], [(1, "a")])
