"""Decontamination against a brute-force scan, on the broadcast and the joined path."""

import hashlib
import re

from assaymill.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        b = words(t)
        n = min(13, len(b))
        windows = {tuple(b[i:i + n]) for i in range(len(b) - n + 1)} if n else set()
        for i in range(len(w) - n + 1):
            if tuple(w[i:i + n]) in windows:
                hit |= set(range(i, i + n))
                if item is not None:
                    found.add(str(item))
    names = ",".join(sorted(found))
    return len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)


LONG = " ".join(f"word{i}" for i in range(40))
ITEMS = [(1, LONG), (10, "Short Item éà"), (2, None), (3, ""), (3, "!!"), (4, LONG.upper()), (None, "null id item"), (5, "a a a a a a a a a a a a a a")]
TEXTS = [None, "", "...", LONG, "x " + LONG + " y", " ".join(f"word{i}" for i in range(5, 17)), "short item ÉÀ", "SHORT, item: éà!",
         "short\0item éà", "null id item", ("filler " * 3000) + LONG, "a " * 50, "word1", "short item", "wordé " + LONG[:120]]


def check(spark, **more):
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)] + [(3, LONG, 1)], "doc_id long, text string, n_hit int")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.annotate(docs, items, **more).collect()
    assert len(got) == len(TEXTS) + 1
    for r in got:
        want = brute(TEXTS[r["doc_id"]], ITEMS)
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == want, TEXTS[r["doc_id"]]


def test_broadcast_set(spark):
    check(spark)


def test_joined_windows_give_the_same(spark):
    check(spark, max_windows=3)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    for most in (10, -1):
        r = decontaminate.annotate(docs, items, max_windows=most).collect()
        assert [(x["n_words"], x["n_hit"], x["contaminated"]) for x in r] == [(2, 0, False)]
    assert decontaminate.annotate(docs.limit(0), items).count() == 0


def test_spans_are_cut(spark):
    docs = spark.createDataFrame([(1, f"Before it. {LONG}. After it, {LONG}"), (2, "nothing here"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, LONG)], "item_id long, text string")
    got = {r["doc_id"]: r["clean_text"] for r in decontaminate.annotate(docs, items, cut_spans=True).collect()}
    assert got == {1: "Before it. . After it, ", 2: "nothing here", 3: None}
