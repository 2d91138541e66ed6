"""Kneser-Ney language models against a direct computation, and held-out accuracy."""

import math
from collections import Counter

import numpy as np
import pytest

from assaymill.llm import language, queries

SMALL = "/root/testdata/sf0.001"
TRAIN = {"aa": ["banana bandana", "an ban nab", "ababab"], "bb": ["rhythm myth", "my hymn", "thyrhm"]}


def padded(text):
    out = "   "
    for c in text.lower():
        c = c if c.isalpha() else " "
        out += "" if c == " " and out[-1] == " " else c
    return out + " "


def brute(texts):
    """P(symbol | context) of an interpolated Kneser-Ney model, by definition."""
    top = Counter(p[i:i + 4] for p in map(padded, texts) for i in range(len(p) - 3))
    orders = {4: top}
    for k in (3, 2, 1):
        orders[k] = Counter(g[1:] for g in orders[k + 1])
    return orders


def probability(orders, alphabet, g):
    k = len(g)
    if k == 0:
        return 1 / (alphabet + 1)
    counts = orders[k]
    ones, twos = sum(v == 1 for v in counts.values()), sum(v == 2 for v in counts.values())
    d = ones / (ones + 2 * twos) if ones and twos else 0.5
    same = {h: v for h, v in counts.items() if h[:-1] == g[:-1]}
    below = probability(orders, alphabet, g[1:])
    if not same:
        return below
    total = sum(same.values())
    return max(counts.get(g, 0) - d, 0) / total + d * len(same) / total * below


def counts(texts):
    key, _ = language.grams(*language.symbols(texts, language.letter_table()))
    return np.unique(key, return_counts=True)


def test_surprisal_is_kneser_ney():
    model = language.Model({lang: counts(t) for lang, t in TRAIN.items()})
    orders = {lang: brute(t) for lang, t in TRAIN.items()}
    alphabet = len(set().union(*(o[1] for o in orders.values())))
    letters = language.letter_table()
    for text in ["banana", "myth", "x", "zebra ban", "", "nab! 12 my"]:
        entropy, n, _, _ = model.judge([text], letters)
        p = padded(text)
        for j, lang in enumerate(model.langs):
            want = -sum(math.log(probability(orders[lang], alphabet, p[i:i + 4])) for i in range(len(p) - 3)) / (len(p) - 3)
            assert n[0] == len(p) - 3 and entropy[0, j] == pytest.approx(want, rel=1e-4)


def test_probabilities_sum_to_one():
    orders = brute(TRAIN["aa"])
    symbols = sorted(orders[1])
    total = sum(probability(orders, len(symbols), "ban" + c) for c in symbols)
    assert 0.9 < total <= 1.0  # the rest is for symbols never seen


def test_hash_array_finds_each_key():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**63, 5000, dtype=np.uint64))
    held = language.HashArray(keys, np.arange(len(keys)))
    assert (held.values[held.find(keys)] == np.arange(len(keys))).all()
    assert (held.find(keys + np.uint64(1))[~np.isin(keys + np.uint64(1), keys)] == -1).all()


def test_held_out_accuracy(spark):
    got = queries.QUERIES["op9_language_id"](spark, SMALL)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang")
    rows = [r for r in got.join(docs, "doc_id").collect()]
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == docs.count() and held
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows) and not any(r["rejected"] for r in rows)


def test_odd_rows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang", "text")
    learned = language.learn(docs)
    odd = [(1, None, "x"), (2, "", "x"), (3, "123 !!", "x"), (None, "the of and that", "x"), (4, "the of and", "x"), (4, "the of and", "x"),
           (5, "Ж" * 4000, "x"), (6, "q", "x"), (7, "zxqj kvwq xzjk " * 400, "x")]
    df = spark.createDataFrame(odd, "doc_id long, text string, score string")
    got = language.predict(df, learned).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(odd)
    assert [by[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and all(by[i]["rejected"] and by[i]["score"] == 0 for i in (1, 2, 3))
    assert by[4]["lang_pred"] == by[None]["lang_pred"] == "en" and not by[4]["rejected"]
    assert by[5]["rejected"] and by[7]["rejected"] and by[6]["lang_pred"] in learned[0]
    assert language.predict(df.limit(0), learned).count() == 0


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    learned = language.learn(df)
    assert learned == ({}, {}) and language.predict(df, learned).first()["lang_pred"] == "und"


def many_languages(spark, n_langs):
    """Documents of languages with alphabets of their own, and one without a language for each."""
    rng = np.random.default_rng(7)
    rows = []
    for j in range(n_langs):
        alphabet = rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 12, replace=False)
        weight = rng.dirichlet(np.ones(12))
        for i in range(8):
            text = " ".join("".join(rng.choice(alphabet, rng.integers(2, 8), p=weight)) for _ in range(30))
            rows.append((len(rows), text, f"l{j:02d}"))
    rows += [(len(rows) + i, t, None) for i, t in enumerate(["", "12 !", "Zażółć gęślą", "ab " * 3000])] + [(None, "abc abd", None)] * 2
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_no_gram_is_lost_whatever_the_shards(spark):
    docs = many_languages(spark, 60).cache()
    whole = language.learn(docs)
    small = language.learn(docs, shard_cells=3000)
    assert len(whole[0].shards) == 1 and len(small[0].shards) > 10 and dict(whole[0]) == dict(small[0]) and len(whole[0]) == 60
    learning = docs.where(language.fold().isin(0, 1) & docs["lang"].isNotNull()).collect()
    texts = {lang: [r["text"] for r in learning if r["lang"] == lang] for lang in whole[0]}
    assert all(whole[0][lang] == len(brute(t)[4]) for lang, t in texts.items() if t)
    want = language.predict(docs, whole).orderBy("doc_id").collect()
    got = language.predict(docs, small).orderBy("doc_id").collect()
    assert len(got) == len(want) == docs.count()
    for a, b in zip(got, want):
        assert (a["doc_id"], a["text"], a["lang"], a["lang_pred"], a["rejected"]) == (b["doc_id"], b["text"], b["lang"], b["lang_pred"], b["rejected"])
        assert a["cross_entropy"] == pytest.approx(b["cross_entropy"], rel=1e-5) and a["score"] == pytest.approx(b["score"], rel=1e-3)


def test_languages_split_by_third_symbol_equal_brute_force(spark):
    docs = many_languages(spark, 3).cache()
    learned = language.learn(docs, shard_cells=60)
    assert any(held == ["l00"] for held in learned[0].held) and len(learned[0].shards) > 6
    learning = docs.where(language.fold().isin(0, 1) & docs["lang"].isNotNull()).collect()
    orders = {lang: brute([r["text"] for r in learning if r["lang"] == lang]) for lang in learned[0]}
    alphabet = len(set().union(*(o[1] for o in orders.values())))
    for r in language.predict(docs.where("length(text) < 400"), learned).collect():
        p = padded(r["text"])
        every = [-sum(math.log(probability(orders[g], alphabet, p[i:i + 4])) for i in range(len(p) - 3)) / (len(p) - 3) for g in sorted(orders)]
        assert r["cross_entropy"] == pytest.approx(min(every), rel=1e-4)


def test_shards_cover_each_language_once():
    cells = {"a": [(1, 5), (2, 9), (40, 1)], "b": [(3, 1)], "c": [(3, 1), (9, 2)]}
    assert language.deal(cells, 10) == [(["a"], (0, 2)), (["a"], (2, 65536)), (["b", "c"], (0, 65536))]
    assert language.deal({}, 10) == [] and language.deal({"a": [(1, 50), (2, 1)]}, 10) == [(["a"], (0, 2)), (["a"], (2, 65536))]


def test_limits_are_those_of_the_calibration_documents(spark):
    docs = many_languages(spark, 4).cache()
    learned = language.learn(docs)
    share = docs.where((language.fold() == language.CALIBRATION) & docs["lang"].isNotNull())
    rows = language.predict(share, (learned[0], {}), detail=True).collect()
    for lang, (limit, allowance) in learned[1].items():
        mine = [r for r in rows if r["lang"] == r["lang_pred"] == lang]
        entropy = sorted(r["cross_entropy"] for r in mine)
        middle, most = entropy[(len(entropy) + 1) // 2 - 1], entropy[-1]
        assert limit == pytest.approx(most + 3 * (most - middle)) and allowance == pytest.approx(4 * np.mean([r["_variance"] for r in mine]) ** 0.5)
    judged = language.predict(docs, learned, detail=True).collect()
    for r in judged:
        a, b = learned[1].get(r["lang_pred"], (math.inf, 0.0))
        letters = any(c.isalpha() for c in r["text"])
        assert r["rejected"] == (not letters or r["cross_entropy"] > a + b / max(r["_n"], 1) ** 0.5)
