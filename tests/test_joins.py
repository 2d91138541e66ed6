"""Substring lookup against a scan of all pairs."""

import random

from assaymill.operators import joins, manual_fetch


def test_contained_in_against_all_pairs(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice("abcd_.10") for _ in range(rng.choice([0, 1, 2, 5, 40, 300]))) for _ in range(60)] + [None, "abc", "abc"]
    needles = [t[i:i + n] for t in texts if t for n in (1, 2, 3, 9, 120) for i in [rng.randrange(max(1, len(t)))] if t[i:i + n]][:150]
    needles += ["", None, "zzz", "abca", "日本", "b", "b"]
    outer = spark.createDataFrame(list(enumerate(texts)), "i int, text string").repartition(3)
    inner = spark.createDataFrame(list(enumerate(needles)), "j int, needle string")
    got = sorted((r["i"], r["j"]) for r in joins.contained_in(outer, "text", inner, "needle").collect())
    assert got == sorted((i, j) for i, t in enumerate(texts) for j, n in enumerate(needles) if t is not None and n and n in t)
    assert joins.contained_in(outer, "text", inner.where("needle = ''"), "needle").count() == 0
    assert joins.contained_in(outer.limit(0), "text", inner, "needle").count() == 0


def test_files_with_long_names_and_several_candidates(spark):
    pad = "supplementary_material_of_the_article_" * 8
    refs = [("ref_001", "10.1/abc", "10.1__abc.pdf"), ("ref_002", "10.1/abcd", "10.1__abcd.pdf"), ("ref_003", "10.9/x.y", "10.9__x.y.pdf")]
    names = ["10.1__abcd.pdf", f"{pad}10.1__abcd_final.PDF", f"{pad}abc{pad}.pdf", "x.y.pdf", f"{pad}.pdf", "__x.pdf"]
    assert max(map(len, names)) > 300
    r = spark.createDataFrame(refs, "id string, doi string, suggested_filename string")
    f = spark.createDataFrame([(n,) for n in names], "filename string")
    got = {x["filename"]: x["id"] for x in manual_fetch.match_files(f, r).collect()}
    assert got == {names[0]: "ref_002", names[1]: "ref_001", names[2]: "ref_001", names[3]: "ref_003", names[5]: "ref_003"}
