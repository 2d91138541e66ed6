"""Importance resampling against brute force, and what it selects among labelled documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from assaymill.llm import arrowtext, queries, resampling

SF = "/root/testdata/sf0.01"


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+|[!-/:-@\[-`{-~]+", low)


def brute(rows, good):
    """log weight by n-grams themselves; equal to the hashed models where no two n-grams share a bucket."""
    grams = [Counter(t) + Counter(zip(t, t[1:], strict=False)) for t in (tokens(x) for _, x in rows)]
    raw, target = Counter(), Counter()
    for (i, _), g in zip(rows, grams, strict=True):
        raw += g
        if i in good:
            target += g
    share = sum(target.values()) / max(1, sum(raw.values()))
    ratio = {g: math.log((target[g] + resampling.PRIOR) / (raw[g] * share + resampling.PRIOR)) for g in raw}
    return [resampling.SHARPNESS * sum(n * ratio[k] for k, n in g.items()) / math.sqrt(max(1, sum(g.values()))) for g in grams]


TEXTS = [None, "", "a b a b", "Some words, some marks!!", "some words some marks", "é è é", "x" * 9000, "the the the " * 900, "a\0b"]


def test_weights_against_brute_force(spark):
    rows = list(enumerate(TEXTS)) + [(3, TEXTS[3])]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, log_weight double")
    labels = spark.createDataFrame([(3, 1, 0), (5, 1, 0), (7, 1, 1), (2, 0, 0), (None, 1, 0), (4, None, None), (6, 1, 0), (6, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    good, share = resampling.good_ids(labels)
    assert good.tolist() == [3, 5] and share == pytest.approx(2 / 6)
    got = resampling.resample(df, labels, share=0.5).collect()
    want = dict(zip([r[0] for r in rows], brute(rows, {3, 5}), strict=True))
    assert len(got) == len(rows)
    for r in got:
        assert r["log_weight"] == pytest.approx(want[r["doc_id"]], abs=1e-9)
    keys = sorted((r["gumbel_key"] for r in got), reverse=True)
    assert {r["doc_id"] for r in got if r["selected"]} == {r["doc_id"] for r in got if r["gumbel_key"] >= keys[4]}


def test_kth_largest_is_exact(spark, monkeypatch):
    monkeypatch.setattr(resampling, "FEW", 5)
    monkeypatch.setattr(resampling, "BINS", 7)
    rng = random.Random(1)
    values = [rng.choice([rng.gauss(0, 1), 3.0, -1e9]) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for k in (1, 2, 100, 150, 299, 300, 1000):
        assert resampling.kth_largest(df, "x", k) == sorted(values, reverse=True)[min(k, 300) - 1]
    assert resampling.kth_largest(df.limit(0), "x", 3) is None


def test_selects_good_documents(spark):
    got = queries.QUERIES["op1_importance_resampling"](spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = got.join(labels, "doc_id").collect()
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    poor = [r["selected"] for r in rows if r["quality"] == 0]
    good = [r["selected"] for r in rows if r["quality"] == 1 and r["toxic"] == 0]
    assert np.mean(good) > 0.75 and np.mean(poor) < 0.2


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a"), (None, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [(r["log_weight"], r["selected"]) for r in resampling.resample(docs, labels).collect()] == [(0.0, True)] * 2
    assert resampling.resample(docs.limit(0), labels).count() == 0


def test_chunks_hold_whole_rows():
    import pyarrow as pa
    batch = pa.record_batch([pa.array(["a" * 10, None, "b" * 50, "", "c"])], ["text"])
    parts = list(arrowtext.chunks([batch], limit=12))
    assert [p.num_rows for p in parts] == [2, 1, 2] and sum(p.num_rows for p in parts) == 5
