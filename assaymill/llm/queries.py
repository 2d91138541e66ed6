"""The queries over these operators, one per operator, and their SQL checks where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaymill.llm import alignment, bpe, decontaminate, html, language, lexical, licenses, neighbours, pairbpe, repeats, resampling, secrets, simhash

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; `sql` is its independent check on the same tables."""
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            CHECKS[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> tuple[dict[bytes, int], str]:
    """The ranks and the split pattern of the public 50k byte-level vocabulary."""
    import public_tokenizers
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN


@query("op1_importance_resampling")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resampling.resample(docs, table(spark, sf_dir, "labels"))


@query("op2_byte_bpe")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.with_tokens(docs, *vocabulary(), keep_text=False, keep_ids=False)


#: Words as the contracts define them, as a DuckDB expression over a text.
SQL_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
             r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


def _license_check() -> str:
    rows = ", ".join(f"({i}, '{label}', {licenses.template_words(t)})" for i, (label, t) in enumerate(licenses.TEMPLATES))
    return f"""
WITH d AS (SELECT doc_id, text, {SQL_WORDS} AS w FROM documents),
t(template, label, words) AS (VALUES {rows}),
places AS (
  SELECT doc_id, p - 1 AS place, CASE WHEN w[p] = 'mit' THEN 'mit' ELSE 'apache' END AS label
  FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS p FROM d) WHERE w[p] IN ('mit', 'apache') AND w[p + 1] = 'license'
  UNION ALL
  SELECT doc_id, p - 1, 'gpl' FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS p FROM d)
  WHERE w[p] = 'general' AND w[p + 1] = 'public' AND w[p + 2] = 'license'),
lines AS (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM d WHERE text IS NOT NULL)),
sets AS (SELECT doc_id, list_distinct({SQL_WORDS}) AS held
         FROM (SELECT doc_id, array_to_string(l[i:i + {licenses.LINES - 1}], ' ') AS text FROM lines)),
found AS (SELECT doc_id, label, len(list_intersect(held, words)) / len(words) AS share FROM sets, t
          WHERE len(list_intersect(held, words)) >= ceil({licenses.THRESHOLD} * len(words))),
base AS (SELECT doc_id, count(*) AS n, min(place) AS a, max(place) AS b, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
         FROM places GROUP BY doc_id),
every AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
          FROM (SELECT doc_id, label FROM places UNION ALL SELECT doc_id, label FROM found) GROUP BY doc_id),
best AS (SELECT doc_id, max(share) AS share FROM found GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, a::BIGINT AS first_word, b::BIGINT AS last_word,
       coalesce(base.labels, '') AS base_labels, coalesce(every.labels, '') AS labels,
       CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN every USING (doc_id) LEFT JOIN best USING (doc_id)
"""


@query("op3_license_scan", _license_check())
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op4_decontaminate", f"""
WITH d AS (SELECT doc_id, {SQL_WORDS} AS w FROM documents),
b AS (SELECT item_id, {SQL_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS win FROM (
         SELECT item_id, w, least(len(w), 13) AS n, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS p FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS win FROM (
         SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
hits AS (SELECT doc_id, p, n, item_id FROM dw JOIN bw USING (n, win)),
places AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS place FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN named USING (doc_id)
""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.annotate(docs, table(spark, sf_dir, "benchmark"), keep_text=False)


@query("op5_html_text")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html.extract(pages, html.fit(pages))


@query("op6_repeated_strings")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)


def _secret_check() -> str:
    assign = (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
              r"""["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""")
    patterns = [("assign", assign, 2, 8), ("access", "AKIA[A-Z0-9]+", 0, 16), ("hex", "[0-9a-f]+", 0, 32), ("owner", "[A-Za-z0-9_-]{20,}", 0, 20)]
    parts = "\n  UNION ALL ".join(f"""
  SELECT doc_id, source, repo, {i} AS kind, '{name}' AS name, {least} AS least, unnest(range(1, len(m) + 1)) AS i, m, v, b FROM (
    SELECT doc_id, source, md5(text) AS repo, regexp_extract_all(text, '{p}', 0) AS m, regexp_extract_all(text, '{p}', {g}) AS v,
           string_split_regex(text, '{p}') AS b FROM d)""" for i, (name, p, g, least) in enumerate(patterns))
    return f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
rows AS ({parts}),
spans AS (SELECT doc_id, source, repo, kind, name, least, v[i] AS value, length(m[i]) AS size,
                 sum(length(b[i]) + length(m[i])) OVER (PARTITION BY doc_id, kind ORDER BY i) AS finish FROM rows),
cand AS (SELECT *, (finish - size)::BIGINT AS start FROM spans WHERE length(value) >= least AND (kind < 3 OR (
           regexp_matches(value, '[0-9]') AND regexp_matches(value, '[a-z]') AND regexp_matches(value, '[A-Z]')))),
own AS (SELECT value, count(DISTINCT source) <= {secrets.MAX_OWNERS} AND count(DISTINCT repo) <= {secrets.MAX_REPOS} AS live FROM cand GROUP BY value),
kept AS (SELECT doc_id, kind, start, name || ':' || start || ':' || finish::BIGINT AS span, live
         FROM cand JOIN own USING (value) WHERE kind < 3 OR live),
per AS (SELECT doc_id, count(*) FILTER (kind = 0) AS a, count(*) FILTER (kind = 1) AS k, count(*) FILTER (kind = 2) AS h,
               string_agg(span, ',' ORDER BY start, kind) FILTER (kind < 3) AS base, string_agg(span, ',' ORDER BY start, kind) AS spans,
               count(*) FILTER (live) AS live, count(*) FILTER (NOT live) AS copied FROM kept GROUP BY doc_id)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(k, 0)::BIGINT AS n_access, coalesce(h, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(live, 0)::BIGINT AS n_live,
       coalesce(copied, 0)::BIGINT AS n_copied
FROM d LEFT JOIN per USING (doc_id)
"""


@query("op7_secret_scan", _secret_check())
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return secrets.scan(docs).drop("source")


@query("op8_cross_polytope")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors, size = neighbours.usable(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return neighbours.search(vectors, vectors.where(F.col("vec_id") % 20 == 0), size)


@query("op9_language_id")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    learned = language.learn(docs)
    held_out = F.coalesce(language.fold() == language.HELD_OUT, F.lit(False))
    return (language.predict(docs.select("doc_id", "text"), learned, keep_text=False)
            .select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected"))


@query("op10_simhash_balls")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.clusters(docs, keep_text=False).select("doc_id", "fingerprint", "component_id")


@query("op11_norm_buckets", f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {SQL_WORDS} AS w FROM documents),
s AS (SELECT count(*) AS docs, sum(len(w))::BIGINT AS terms FROM d WHERE len(w) > 0),
b AS (SELECT row_number() OVER () AS item, item_id, {SQL_WORDS} AS w FROM benchmark),
q AS (SELECT item, term, count(*) AS times FROM (SELECT item, unnest(w) AS term FROM b) GROUP BY item, term),
f AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY row, term),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS weight
            FROM (SELECT term, count(*) AS df FROM f GROUP BY term), s),
m AS (SELECT row, doc_id, 100 - 75 + (75 * len(w) * docs) // terms AS m FROM d, s WHERE len(w) > 0),
scores AS (SELECT item, row, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
           FROM q JOIN f USING (term) JOIN weights USING (term) JOIN m USING (row) GROUP BY item, row),
ranked AS (SELECT item, doc_id, score, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank
           FROM scores JOIN m USING (row) WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked JOIN b USING (item) WHERE rank <= 10
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lexical.search(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


@query("op12_pointer_jumping")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    a, b = (alignment.read_vocabulary(public_tokenizers.path(n)) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align(docs, a, b, keep_text=False)


@query("op13_pair_index_bpe")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = pairbpe.read_vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    return pairbpe.with_tokens(docs, vocabulary, keep_text=False, keep_ids=False)
