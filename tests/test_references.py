"""One call per key, one rate per job, and reference texts from cache, corpus and service in that order."""

import json
import os
import time
from collections import Counter

import pytest

from assaymill import steps
from assaymill.operators import extraction, references
from assaymill.sources import pacing, repositories, snapshots

CACHE = "doi string, pmc_id string, title string, full_text string, source string"
PAPERS = "id long, doi string, pmid string, title string, full_text string"


def logged(folder, answer):
    """A transport that notes the key and time of each call in the folder."""
    os.makedirs(folder, exist_ok=True)

    def transport(key):
        with open(os.path.join(folder, str(os.getpid())), "a") as f:
            f.write(json.dumps([time.time(), key]) + "\n")
        return answer(key)
    return transport


def calls(folder):
    return sorted(json.loads(line) for name in os.listdir(folder) for line in open(os.path.join(folder, name)))


@pytest.mark.parametrize("tasks", [2, 8])
def test_rate_does_not_grow_with_tasks(spark, tmp_path, tasks):
    keys = spark.range(0, 40, 1, tasks).selectExpr("CAST(id AS STRING) AS k")
    folder = str(tmp_path / "calls")
    got = repositories.fetch(keys, "k", logged(folder, str.upper), per_second=20, lanes=4).collect()
    at = [t for t, _ in calls(folder)]
    assert len(got) == len(at) == 40
    assert all(j - i <= 20 * (at[j] - at[i]) + 4.5 for i in range(40) for j in range(i, 40))


def test_rate_counts_failed_tries_and_models(spark, tmp_path):
    def down(key):
        raise OSError(key)
    keys = spark.createDataFrame([("a",), ("b",)], "k string")
    got = repositories.fetch(keys, "k", logged(str(tmp_path / "a"), down), per_second=10, lanes=2, tries=3).collect()
    at = [t for t, _ in calls(str(tmp_path / "a"))]
    assert [r["answer"] for r in got] == [None, None] and len(at) == 6 and at[-1] - at[0] >= 0.35
    prompts = spark.range(0, 12, 1, 6).selectExpr("id", "'s' AS system", "'p' AS prompt")
    asked = extraction.ask(prompts, logged(str(tmp_path / "b"), lambda m: "{}"), calls_per_second=100)
    assert asked.rdd.getNumPartitions() == pacing.LANES and {r["id"] for r in asked.collect()} == set(range(12))


def test_slots_keep_their_distance():
    now, slept = [0.0], []

    def sleep(s):
        slept.append(s)
        now[0] += s
    wait = pacing.slots(2, lanes=1, clock=lambda: now[0], sleep=sleep)
    wait(), wait()
    now[0] += 5  # a slow call earns no burst
    wait(), wait()
    assert slept == [0.5, 0.5]
    pacing.slots(None)()


def test_equal_wants_are_one_call(spark, tmp_path):
    wants = spark.createDataFrame([(i, k, "old") for i, k in enumerate(["a", "a", "b", None, "bad", "known", "a", ""])], "id int, k string, answer string")
    known = spark.createDataFrame([("known", "K"), ("known", "J"), ("b", None)], "k string, answer string")
    folder = str(tmp_path / "calls")

    def answer(k):
        if k == "bad":
            raise OSError
        return k.upper()
    rows, new = repositories.answered(wants, "k", known, logged(folder, answer))
    assert {r["id"]: r["answer"] for r in rows.collect()} == {0: "A", 1: "A", 2: "B", 3: None, 4: None, 5: "K", 6: "A", 7: ""}
    assert {tuple(r) for r in new.collect()} == {("a", "A"), ("b", "B"), ("", "")}
    assert rows.count() == 8 and new.count() == 3  # read again, nothing is asked again
    assert Counter(k for _, k in calls(folder)) == {"a": 1, "b": 1, "bad": 3, "": 1}
    assert repositories.answered(wants.limit(0), "k", known, str.upper)[0].count() == 0


def service(folder):
    def answer(key):
        if key == "10.1/odd":
            return "no JSON"
        return json.dumps({"title": f"T {key}", "text": "" if key == "10.1/empty" else f"text of {key}", "pmc_id": "PMC9"})
    return logged(folder, answer)


def test_cache_then_corpus_then_service(spark, tmp_path):
    wants = [("10.1/c", "1"), ("10.1/p", None), ("10.1/x", "2"), ("10.1/n", None), ("10.1/n", None), (None, "7"), (" ", ""), ("10.1/empty", None), ("10.1/odd", None)]
    requests = spark.createDataFrame(wants, "doi string, pmid string")
    cache = spark.createDataFrame([("10.1/c", "PMC1", "C", "cached", "s"), ("10.1/n", None, "old title", "", "s"), ("10.1/p", None, None, None, "s")], CACHE)
    papers = spark.createDataFrame([(1, "10.1/p", "1", "P", "of the corpus"), (2, "10.1/q", "2", "Q", "by number"), (3, "10.1/c", "3", "no", "not this")], PAPERS)
    folder = str(tmp_path / "calls")
    got, new = references.fetch_references(requests, cache, papers, service(folder))
    rows = [(r["doi"], r["pmid"], r["source"], r["text"]) for r in got.collect()]
    want = [("10.1/c", "1", "cache", "cached"), ("10.1/p", None, "in_corpus", "of the corpus"), ("10.1/x", "2", "in_corpus", "by number"),
            ("10.1/n", None, "fetched", "text of 10.1/n"), ("10.1/n", None, "fetched", "text of 10.1/n"), (None, "7", "fetched", "text of pmid:7"),
            (None, None, "not_found", None), ("10.1/empty", None, "not_found", None), ("10.1/odd", None, "not_found", None)]
    assert Counter(rows) == Counter(want)
    assert Counter(k for _, k in calls(folder)) == dict.fromkeys(["10.1/n", "pmid:7", "10.1/empty", "10.1/odd"], 1)
    merged = references.written_back(cache, new)
    assert {(r["doi"], r["title"], r["full_text"]) for r in merged.collect()} == {
        ("10.1/c", "C", "cached"), ("10.1/n", "T 10.1/n", "text of 10.1/n"), ("10.1/p", None, None), (None, "T pmid:7", "text of pmid:7")}
    assert all(r["cached_at"] for r in merged.where("source = 'fetch_reference'").collect())
    short, _ = references.fetch_references(requests, merged, papers, service(str(tmp_path / "again")), budget=6)
    assert {r["source"] for r in short.where("doi = '10.1/n'").collect()} == {"cache"} and short.where("text LIKE 'cached%'").count() == 1


def test_step_asks_once_and_fills_the_cache(spark, tmp_path):
    root, folder = str(tmp_path / "tables"), str(tmp_path / "calls")
    t = steps.load(spark, root)
    protocols = spark.createDataFrame([(i, 1, d) for i, d in enumerate(["10.1/new", "10.1/new", "10.1/own", None, " "])], "id long, paper_id long, base_protocol_doi string")
    papers = spark.createDataFrame([(5, "PMC5", "10.1/own", "Own")], "id long, pmc_id string, doi string, title string")
    texts = spark.createDataFrame([(5, "whole text")], "paper_id long, text string")
    snapshots.commit(spark, root, {n: t[n].unionByName(df, allowMissingColumns=True) for n, df in (("protocols", protocols), ("papers", papers), ("paper_texts", texts))})
    options = {"reference_transport": service(folder), "reference_rate": 50}
    assert steps.run(spark, root, {}, only=8.5) == ["fetch_references"] and steps.load(spark, root)["corpus_cache"].count() == 0
    for _ in range(2):
        assert steps.run(spark, root, options, only=8.5) == ["fetch_references"]
    assert [(r["doi"], r["full_text"]) for r in steps.load(spark, root)["corpus_cache"].collect()] == [("10.1/new", "text of 10.1/new")]
    assert [k for _, k in calls(folder)] == ["10.1/new"]
