"""The pipeline against the brute-force versions of its stages."""

import re

import pytest
import test_decontaminate
import test_secrets
import test_simhash

import corpus_pipeline
from assaymill.llm import queries

tiktoken = pytest.importorskip("tiktoken")
SMALL = "/root/testdata/sf0.001"


def redacted(rows):
    """rows of (doc_id, source, text): texts without spans of values that at most three owners and ten texts hold."""
    found, owners, texts = {}, {}, {}
    for i, (_, source, text) in enumerate(rows):
        for k, (_, p, g, least) in enumerate(test_secrets.PATTERNS):
            for m in p.finditer(text or ""):
                v = m.group(g)
                mixed = all(re.search(c, v) for c in ("[0-9]", "[a-z]", "[A-Z]"))
                if len(v) >= least and (k < 3 or mixed):
                    found.setdefault(i, []).append((m.start(), m.end(), v))
                    owners.setdefault(v, set()).update({source} - {None})
                    texts.setdefault(v, set()).add(text)
    out = []
    for i, (_, _, text) in enumerate(rows):
        spans, merged = sorted(s[:2] for s in found.get(i, []) if len(owners[s[2]]) <= 3 and len(texts[s[2]]) <= 10), []
        for a, b in spans:
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        for a, b in reversed(merged):
            text = text[:a] + "[secret]" + text[b:]
        out.append(text)
    return out


def test_run_against_brute_force(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    kept = {i: d for i, d in docs.items() if any(c.isalpha() for c in d["text"] or "")}
    prints = {i: test_simhash.brute_fingerprint(d["text"]) for i, d in kept.items()}
    group, least = test_simhash.brute_components(set(prints.values())), {}
    for i, f in prints.items():
        least[group[f]] = min(i, least.get(group[f], i))
    left = [i for i in sorted(set(least.values())) if not test_decontaminate.brute(docs[i]["text"], items)[4]]
    texts = redacted([(i, docs[i]["source"], docs[i]["text"]) for i in left])
    ranks, pattern = queries.vocabulary()
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert sorted(got) == left and len(left) < len(docs)
    for i, text in zip(left, texts, strict=True):
        assert got[i]["ids"] == library.encode_ordinary(text) and got[i]["n_chars"] == len(text)
        assert (got[i]["lang"], got[i]["source"]) == (docs[i]["lang"], docs[i]["source"])


def odd(spark):
    base = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").limit(60).collect()]
    more = [(9000, None, None, None, None), (9001, "", "en", "s", 0), (9002, "123", "en", "s", 3), (None, "the of and that this", "en", None, 20),
            (9003, "the of and", "en", "s", 10), (9003, "the of and", "en", "s", 10)]
    return spark.createDataFrame([(*r, "kept", 0.25) for r in base + more],
                                 "doc_id long, text string, lang string, source string, n_chars long, rejected string, score double")


def test_stages_keep_columns_and_stand_odd_rows(spark):
    docs = odd(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert rows and all(r["rejected"] == "kept" and r["score"] == 0.25 for r in rows), name
        ids = [r["doc_id"] for r in rows]
        assert (9002 in ids) == (name != "language_id") and None in ids
        assert ids.count(9003) == (1 if name == "simhash_dedup" else 2)
        assert stage(spark, docs.limit(0), SMALL).count() == 0, name
    assert "ids" in corpus_pipeline.byte_bpe(spark, docs, SMALL).columns


def test_stage_list():
    assert 4 <= len(corpus_pipeline.STAGES) <= 5 and [n for n, _ in corpus_pipeline.STAGES][0] == "language_id"
