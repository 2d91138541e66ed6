"""SimHash fingerprints and components against brute force."""

import random
import re

import numpy as np
import pytest

from assaymill.llm import components, simhash

xxhash = pytest.importorskip("xxhash")


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    parent = {f: f for f in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    fs = sorted(parent)
    for i, a in enumerate(fs):
        for b in fs[:i]:
            if bin(a ^ b).count("1") <= 4:
                parent[root(a)] = root(b)
    return {f: root(f) for f in fs}


def near_fingerprints(n, seed=5):
    rng, out = random.Random(seed), [0]
    while len(out) < n:
        base = rng.choice(out) if rng.random() < 0.7 else rng.getrandbits(64)
        for b in rng.sample(range(64), rng.choice([1, 2, 3, 4, 5, 6])):
            base ^= 1 << b
        out.append(base)
    return sorted(set(out))


@pytest.mark.parametrize("hot_rows", [simhash.HOT_ROWS, 20])
def test_links_keep_every_component(spark, hot_rows):
    fps = near_fingerprints(250)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    got = {r["node"]: r["component"] for r in components.components(simhash.links(df, hot_rows=hot_rows)).collect()}
    want = brute_components(fps)
    groups = {}
    for f, s in zip(fps, signed, strict=True):
        groups.setdefault(want[f], set()).add(got.get(s, s))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_documents_against_brute_force(spark):
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(60)]
    base = [" ".join(rng.choice(vocab) for _ in range(rng.choice([3, 30, 200]))) for _ in range(25)]
    texts = [None, "", " \t\n", "One", "one", "É é", "é É"]
    for b in base:
        texts += [b, b.upper(), b.replace("w5 ", "w6 ", 1), b + " tail"]
    rows = [(1000 - i, t, "x") for i, t in enumerate(texts)] + [(1000, None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")
    got = simhash.clusters(df).collect()
    assert len(got) == len(rows)
    fp = {i: brute_fingerprint(t) for i, t, _ in rows}
    comp = brute_components(set(fp.values()))
    least = {}
    for i, f in fp.items():
        least[comp[f]] = min(i, least.get(comp[f], i))
    for r in got:
        assert r["fingerprint"] == f"{fp[r['doc_id']]:016x}"
        assert r["component_id"] == least[comp[fp[r["doc_id"]]]]
    kept = simhash.keep_one(df)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(least.values()))
    assert kept.columns == df.columns


def test_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a b c d e"), (7, "a b c d e"), (None, "quite another text here")], "doc_id long, text string")
    got = sorted((str(r["doc_id"]), str(r["component_id"])) for r in simhash.clusters(df).collect())
    assert got == [("7", "7"), ("None", "7"), ("None", "None")]
    assert simhash.clusters(df.limit(0)).count() == 0


def test_keep_one_with_null_and_repeated_ids(spark):
    rng = random.Random(6)
    texts = [" ".join(rng.choice("abcdefghij") * 3 + str(rng.randrange(900)) for _ in range(40)) for _ in range(6)]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (5, texts[2]), (5, texts[3]), (3, texts[3]), (5, texts[4]), (None, texts[4]), (7, texts[5]),
            (7, texts[5])]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    want = [(None, texts[0]), (None, texts[1]), (5, texts[2]), (3, texts[3]), (5, texts[4]), (7, texts[5])]
    assert sorted((r["text"], r["doc_id"]) for r in kept) == sorted((t, i) for i, t in want)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (5, 5)], "a long, b long")
    got = {r["node"]: r["component"] for r in components.components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
