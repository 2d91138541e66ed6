"""Nearest neighbours against brute force."""

import numpy as np
import pytest

from assaymill.llm import neighbours, queries


def brute(ids, x, query_ids, most=20):
    out = {}
    for q in query_ids:
        i = int(np.flatnonzero(ids == q)[0])
        score = x @ x[i]
        order = [j for j in np.lexsort([ids, -score]) if ids[j] != q][:most]
        out[int(q)] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def recall(got, want):
    held = {}
    for r in got:
        held.setdefault(r["query_id"], []).append(r)
    hits = total = 0
    for q, best in want.items():
        rows = sorted(held.get(q, []), key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1))
        assert all(a["score"] > b["score"] or (a["score"] == b["score"] and a["vec_id"] < b["vec_id"]) for a, b in zip(rows, rows[1:], strict=False))
        ids = {r["vec_id"] for r in rows}
        hits += sum(v in ids for v, _ in best)
        total += len(best)
    return hits / total


@pytest.mark.parametrize("spread", [False, True])
def test_recall_beyond_the_sample(spark, spread):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 24)) + rng.normal(size=(12, 24))[rng.integers(0, 12, 3000)]
    x /= np.linalg.norm(x, axis=1)[:, None]
    if spread:
        x *= rng.uniform(0.5, 2, (len(x), 1))
    x[5:25] = x[4]  # copies: ties go to the smaller id
    ids = np.arange(len(x))
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>").repartition(3)
    vectors, size = neighbours.usable(df)
    asked = vectors.where("vec_id % 100 = 4")
    got = neighbours.search(vectors, asked, size, sample=200, hot_rows=60).collect()
    want = brute(ids, x, [i for i in ids if i % 100 == 4])
    assert recall(got, want) >= 0.9
    for r in got:
        assert r["score"] == pytest.approx(float(x[r["query_id"]] @ x[r["vec_id"]]), abs=1e-12)
    assert [r["vec_id"] for r in sorted((r for r in got if r["query_id"] == 4), key=lambda r: r["rank"])] == list(range(5, 25))


@pytest.mark.parametrize("width", [64, 128, 256])
@pytest.mark.parametrize("equal", [True, False])
def test_vectors_without_structure(spark, width, equal):
    x = np.random.default_rng(width).normal(size=(4000, width))
    x = x / np.linalg.norm(x, axis=1)[:, None] if equal else x
    ids = np.arange(len(x))
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>").repartition(3)
    vectors, size = neighbours.usable(df)
    got = neighbours.search(vectors, vectors.where("vec_id % 200 = 0"), size).collect()
    assert len(got) == 20 * 20
    assert recall(got, brute(ids, x, ids[ids % 200 == 0])) >= 0.9


def test_two_axes_and_few_probes(spark):
    """Buckets of two axes; queries whose buckets hold too little are searched in full."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(10, 8))[rng.integers(0, 10, 3000)] + 0.2 * rng.normal(size=(3000, 8))
    ids = np.arange(len(x))
    vectors, size = neighbours.usable(spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>"))
    asked, want = vectors.where("vec_id % 100 = 0"), brute(ids, x, ids[ids % 100 == 0])
    for probing in (None, neighbours.Probing(2, 4, 40), neighbours.Probing(2, 1, 1)):
        got = neighbours.search(vectors, asked, size, probing=probing, hot_rows=100, hot_queries=4).collect()
        assert len(got) == 30 * 20
        assert recall(got, want) >= (0.3 if probing and probing.probes == 1 else 0.9)


@pytest.mark.parametrize("name", ["sf0.001", "sf0.01", "sf0.1"])
def test_the_tables_alone_find_the_answer(spark, name):
    sf = f"/root/testdata/{name}"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    got = queries.QUERIES["op8_cross_polytope"](spark, sf).collect()
    assert len(got) == 20 * (ids % 20 == 0).sum()
    assert recall(got, brute(ids, x, ids[ids % 20 == 0])) >= 0.9


def test_the_sample_changes_no_answer(spark):
    rng = np.random.default_rng(8)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(1500, 32)))], "vec_id long, embedding array<double>")
    vectors, size = neighbours.usable(df)
    asked = vectors.where("vec_id % 50 = 0")
    answers = [sorted(tuple(r) for r in neighbours.search(vectors, asked, size, probing=neighbours.Probing(1, 8, 30), sample=sample).collect()) for sample in (30, 1 << 14)]
    assert answers[0] == answers[1] and len(answers[0]) == 30 * 20


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0, 0.0]), (20, [0.0, 2.0, 0.0]), (40, None), (60, [0.0, 0.0, 0.0]), (80, [nan, 1.0, 0.0]), (1, [inf, 0.0, 0.0]),
            (2, [None, 1.0, 0.0]), (None, [1.0, 1.0, 1.0]), (3, [1.0, 1.0, 0.0]), (3, [0.0, 1.0, 0.0]), (4, [1.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, score string")
    vectors, size = neighbours.usable(df)
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in neighbours.search(vectors, vectors.where("vec_id % 20 = 0"), size).collect()}
    assert got == {(0, 1): (3, 1.0), (0, 2): (20, 0.0), (20, 1): (3, 2.0), (20, 2): (0, 0.0)}
    none, size = neighbours.usable(df.limit(0))
    assert neighbours.search(none, none, size).count() == 0


def test_hadamard_is_orthonormal():
    h = neighbours.hadamard(np.eye(16))
    assert np.allclose(h @ h.T, np.eye(16))
