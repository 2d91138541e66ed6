"""Worklists, upserts, references, search, statistics, audit, cross-referencing."""

from __future__ import annotations

from pyspark.sql import functions as F

from assaymill.functions import accessions as AC
from assaymill.operators import audit, crossref, graph, search, stats, upserts, worklists
from assaymill.plans import adapters as A
from assaymill.plans.expression_queries import rounded
from assaymill.plans.registry import query

PASSED = "('primary_protocol', 'disease_model', 'methods_tool', 'review')"
EXTRACT = "('primary_protocol', 'disease_model', 'methods_tool')"


def table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


# -- worklists -------------------------------------------------------------------------------------------------

WORKLISTS = {
    "text": (worklists.needing_text, f"triage_category IN {PASSED} AND parsed_text_path IS NULL AND xml_path IS NOT NULL"),
    "extraction": (worklists.for_extraction,
                   f"triage_category IN {EXTRACT} AND extraction_status = 'pending' AND parsed_text_path IS NOT NULL"),
    "review": (lambda p: worklists.for_extraction(p, "review"),
               "triage_category = 'review' AND extraction_status = 'pending' AND parsed_text_path IS NOT NULL"),
    "geo": (worklists.needing_geo, f"triage_category IN {PASSED} AND extraction_status = 'completed' AND geo_status IS NULL"),
    "rnaseq": (worklists.needing_rnaseq, "extraction_status = 'completed' AND rnaseq_status IS NULL"),
    "supplement_fetch": (worklists.supplements_to_fetch,
                         f"triage_category IN {PASSED} AND xml_path IS NOT NULL AND supplement_dir IS NULL"),
    "supplement_text": (worklists.supplements_to_process,
                        "supplement_dir IS NOT NULL AND supplement_dir <> 'none' AND supplement_text_path IS NULL"),
}
for _name, (_fn, _where) in WORKLISTS.items():
    query(f"worklist_{_name}", A.sql(f"SELECT id, pmc_id, processing_priority FROM pa WHERE {_where}", A.PA))(
        lambda spark, sf, fn=_fn: fn(A.papers(spark, sf)).select("id", "pmc_id", "processing_priority"))

# Series of a paper and their samples: orders stand for series, their lines for samples, shipped ones are mapped.
SERIES = "se AS (SELECT o_orderkey AS id, o_custkey AS paper_id, o_orderstatus = 'F' AS soft_fetched FROM orders)"


def _series(spark, sf):
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey AS id", "o_custkey AS paper_id", "o_orderstatus = 'F' AS soft_fetched", "'own_data' AS context")


def _line_samples(spark, sf):
    return table(spark, sf, "lineitem").selectExpr(
        "l_orderkey * 10 + l_linenumber AS id", "l_orderkey AS geo_accession_id", "l_returnflag").distinct()


@query("worklist_mapping", A.sql(
    "SELECT id, pmc_id FROM pa WHERE id IN (SELECT se.paper_id FROM se JOIN lineitem l ON l.l_orderkey = se.id WHERE se.soft_fetched "
    "AND l.l_orderkey * 10 + l.l_linenumber NOT IN (SELECT l_orderkey * 10 + l_linenumber FROM lineitem WHERE l_returnflag = 'R'))",
    A.PA, SERIES))
def worklist_mapping(spark, sf):
    s = _line_samples(spark, sf)
    maps = s.where("l_returnflag = 'R'").select(F.col("id").alias("geo_sample_id"))
    return worklists.needing_mapping(A.papers(spark, sf), _series(spark, sf), s, maps).select("id", "pmc_id")


@query("worklist_crossref", A.sql(
    "SELECT id, pmc_id FROM pa WHERE id % 2 = 0 AND id % 5 <> 0 AND id NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')",
    A.PA))
def worklist_crossref(spark, sf):
    c = table(spark, sf, "customer")
    rna = c.selectExpr("c_custkey AS paper_id", "c_custkey % 2 = 0 AS has_rnaseq",
                       "CASE WHEN c_custkey % 5 <> 0 THEN array('GSE1') END AS accessions")
    repo = table(spark, sf, "orders").where("o_orderstatus = 'P'").selectExpr("o_custkey AS paper_id")
    return worklists.needing_crossref(A.papers(spark, sf), rna, repo).select("id", "pmc_id")


@query("worklist_enrichment", A.sql(
    f"SELECT id, pmc_id FROM pa WHERE supplement_text_path IS NOT NULL AND extraction_status = 'completed' AND triage_category IN {EXTRACT} "
    "AND id NOT IN (SELECT paper_id FROM pr WHERE pass_number >= 3)", A.PA, A.PR))
def worklist_enrichment(spark, sf):
    return worklists.needing_enrichment(A.papers(spark, sf), A.protocols(spark, sf)).select("id", "pmc_id")


@query("semi_export", A.sql(
    "SELECT id, paper_id, protocol_arm FROM pr WHERE id IN (SELECT DISTINCT protocol_id FROM ev WHERE protocol_id IS NOT NULL)",
    A.PR, A.EV))
def semi_export(spark, sf):
    return worklists.protocols_with_expression(A.protocols(spark, sf), A.values(spark, sf)).select(
        "id", "paper_id", "protocol_arm")


@query("route_sources", A.sql(
    "SELECT id, pmc_id, CASE WHEN id % 8 = 0 THEN 'geo_with_matrix' WHEN id % 8 = 1 THEN 'geo_raw_only' WHEN supplement_dir IS NOT NULL "
    "AND supplement_dir <> 'none' THEN 'supplement' ELSE 'text_only' END AS source FROM pa WHERE id % 3 <> 0 AND id NOT IN "
    "(SELECT paper_id FROM ev)", A.PA, A.EV))
def route_sources(spark, sf):
    rna = table(spark, sf, "customer").selectExpr(
        "c_custkey AS paper_id", "c_custkey % 3 <> 0 AS has_rnaseq",
        "named_struct('classification', CASE c_custkey % 8 WHEN 0 THEN 'geo_with_matrix' WHEN 1 THEN 'geo_raw_only' ELSE 'ena_only' END) "
        "AS data_availability")
    return worklists.route_sources(A.papers(spark, sf), rna, A.values(spark, sf))


@query("set_difference",
       "SELECT DISTINCT 'PMC' || doc_id AS pmc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1 OR toxic = 0)")
def set_difference(spark, sf):
    items = table(spark, sf, "documents").selectExpr("'PMC' || doc_id AS pmc_id").distinct()
    log = table(spark, sf, "labels").selectExpr(
        "'PMC' || doc_id AS pmc_id", "CASE WHEN quality = 1 THEN NULL WHEN toxic = 0 THEN 'no_abstract' ELSE 'api_error: 500' END AS error")
    return worklists.not_done(items, log)


@query("union_dedup",
       "SELECT o_custkey AS pmc_id, MIN(CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END) AS query_no FROM orders GROUP BY 1")
def union_dedup(spark, sf):
    o = table(spark, sf, "orders").withColumnRenamed("o_custkey", "pmc_id")
    return worklists.union_dedup([o.where(F.col("o_orderstatus") == s) for s in ("F", "O", "P")])


@query("net_new",
       "SELECT q AS query_no, COUNT(*) AS net_new FROM (SELECT o_custkey, MIN(CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END) "
       "AS q FROM orders GROUP BY 1) t GROUP BY 1")
def net_new(spark, sf):
    return worklists.net_new(union_dedup(spark, sf))


@query("last_per_key",
       "SELECT user_id, event_type, value, event_id FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn "
       "FROM events) q WHERE rn = 1")
def last_per_key(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_type", "value", "event_id")
    return worklists.last_per_key(e, ["user_id"], "event_id")


# -- upserts ---------------------------------------------------------------------------------------------------

# Old rows: one per customer. New rows: that customer's orders in key order, half of their fields missing.
UP_OLD = ("old AS (SELECT c_custkey AS k, 0 AS seq, CASE WHEN c_custkey % 2 = 0 THEN 'ambiguous' END AS context, "
          "CASE WHEN c_custkey % 3 = 0 THEN CAST(0.5 AS DOUBLE) END AS confidence, 'old' AS strategy FROM customer WHERE c_custkey % 4 <> 3)")
UP_NEW = ("new AS (SELECT o_custkey AS k, o_orderkey + 1 AS seq, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END AS context, "
          "CASE WHEN o_orderkey % 2 = 0 THEN (o_orderkey % 100) / CAST(100 AS DOUBLE) END AS confidence, "
          "CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS strategy FROM orders)")
UP_ALL = "every AS (SELECT * FROM old UNION ALL SELECT * FROM new)"


def _old_new(spark, sf):
    old = table(spark, sf, "customer").where("c_custkey % 4 <> 3").selectExpr(
        "c_custkey AS k", "CASE WHEN c_custkey % 2 = 0 THEN 'ambiguous' END AS context",
        "CASE WHEN c_custkey % 3 = 0 THEN CAST(0.5 AS DOUBLE) END AS confidence", "'old' AS strategy")
    new = table(spark, sf, "orders").selectExpr(
        "o_custkey AS k", "o_orderkey + 1 AS seq", "CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END AS context",
        "CASE WHEN o_orderkey % 2 = 0 THEN (o_orderkey % 100) / CAST(100 AS DOUBLE) END AS confidence",
        "CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS strategy")
    return old, new


@query("upsert_coalesce", A.sql(
    "SELECT k, arg_max(context, seq) FILTER (WHERE context IS NOT NULL) AS context, MAX(COALESCE(confidence, 0)) AS confidence, "
    "(list(strategy ORDER BY seq DESC))[1] AS strategy FROM every GROUP BY k", UP_OLD, UP_NEW, UP_ALL))
def upsert_coalesce(spark, sf):
    old, new = _old_new(spark, sf)
    return upserts.upsert(old, new, ["k"], {"context": "coalesce", "confidence": "max", "strategy": "overwrite"})


@query("upsert_overwrite", A.sql(
    "SELECT k, context, confidence, strategy FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY k ORDER BY seq DESC) AS rn FROM every) q "
    "WHERE rn = 1", UP_OLD, UP_NEW, UP_ALL))
def upsert_overwrite(spark, sf):
    old, new = _old_new(spark, sf)
    return upserts.upsert(old, new, ["k"], dict.fromkeys(["context", "confidence", "strategy"], "overwrite"))


@query("upsert_keep_first", A.sql(
    "SELECT k, context FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY k ORDER BY seq) AS rn FROM every) q WHERE rn = 1",
    UP_OLD, UP_NEW, UP_ALL))
def upsert_keep_first(spark, sf):
    old, new = _old_new(spark, sf)
    return upserts.upsert(old, new, ["k"], {"context": "keep"})


@query("cache_longest", A.sql(
    "SELECT doi, (list(title ORDER BY seq DESC) FILTER (WHERE title IS NOT NULL))[1] AS title, "
    "CAST(MAX(len) AS INTEGER) AS text_length, (list(source ORDER BY seq DESC))[1] AS source FROM rec GROUP BY doi",
    "d AS (SELECT doc_id AS seq, lang || '/' || source AS doi, CASE WHEN doc_id % 3 = 0 THEN 'T' || doc_id END AS title, "
    "length(text) AS len, 's' || doc_id AS source FROM documents)",
    "rec AS (SELECT * FROM (SELECT *, MAX(len) OVER (PARTITION BY doi ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) "
    "AS prev FROM d) q WHERE prev IS NULL OR len > prev)"))
def cache_longest(spark, sf):
    new = table(spark, sf, "documents").selectExpr(
        "doc_id AS seq", "lang || '/' || source AS doi", "CAST(NULL AS STRING) AS pmc_id",
        "CASE WHEN doc_id % 3 = 0 THEN 'T' || doc_id END AS title", "text AS full_text", "'s' || doc_id AS source")
    middle = new.agg(F.max("seq")).first()[0] / 2  # the earlier writes are merged first, the later ones into what they left
    old = upserts.cache_longest(new.limit(0), new.where(F.col("seq") <= middle))
    out = upserts.cache_longest(old, new.where(F.col("seq") > middle))
    return out.select("doi", "title", F.length("full_text").alias("text_length"), "source")


@query("longest_text",
       "SELECT doi, text_length, title FROM (SELECT lang || '/' || source AS doi, CAST(length(text) AS INTEGER) AS text_length, 'T' || doc_id AS title, "
       "ROW_NUMBER() OVER (PARTITION BY lang, source ORDER BY length(text) DESC, 'T' || doc_id) AS rn FROM documents) q WHERE rn = 1")
def longest_text(spark, sf):
    c = table(spark, sf, "documents").selectExpr("lang || '/' || source AS doi", "'T' || doc_id AS title", "text AS full_text")
    return upserts.longest_text(c).select("doi", F.length("full_text").alias("text_length"), "title")


@query("delete_cascade",
       "SELECT 'accession' AS kind, COUNT(*) AS n FROM orders WHERE o_orderstatus <> 'F' UNION ALL "
       "SELECT 'sample', COUNT(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders "
       "WHERE o_orderstatus = 'F')) q UNION ALL SELECT 'mapping', COUNT(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders "
       "WHERE o_orderstatus = 'F')")
def delete_cascade(spark, sf):
    acc = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), "o_orderstatus")
    lines = table(spark, sf, "lineitem").selectExpr("l_orderkey * 10 + l_linenumber AS id", "l_orderkey AS geo_accession_id")
    maps = lines.select(F.col("id").alias("geo_sample_id"))
    a, s, m = upserts.delete_accessions(acc, lines.distinct(), maps, acc.where("o_orderstatus = 'F'"))
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("kind"), "n")
             for k, df in (("accession", a), ("sample", s), ("mapping", m))]
    return upserts.union_all(parts)


@query("patch_rows", A.sql(
    "SELECT pa.id, CASE WHEN d.k IS NOT NULL THEN d.s ELSE pa.extraction_status END AS extraction_status FROM pa LEFT JOIN "
    "(SELECT o_custkey AS k, MAX(o_orderstatus) AS s FROM orders GROUP BY 1) d ON d.k = pa.id", A.PA))
def patch_rows(spark, sf):
    u = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.max("o_orderstatus").alias("extraction_status"))
    return upserts.patch(A.papers(spark, sf), u, "id", ["extraction_status"]).select("id", "extraction_status")


# -- references ------------------------------------------------------------------------------------------------

# Each order cites a paper by DOI, PubMed id or PMC id, some outside the corpus.
REFS = ("SELECT o_orderkey AS ref_no, o_custkey AS paper_id, CASE WHEN o_orderkey % 3 = 0 THEN '10.1000/x' || (o_orderkey % 2000) END AS doi, "
        "CASE WHEN o_orderkey % 3 <> 2 THEN CAST(30000000 + o_orderkey % 1700 AS STRING) END AS pmid, "
        "CASE WHEN o_orderkey % 2 = 0 THEN 'PMC' || (1000000 + o_orderkey % 1600) END AS pmc_id FROM {orders}")


def _refs(spark, sf):
    return table(spark, sf, "orders").selectExpr(*[
        "o_orderkey AS ref_no", "o_custkey AS paper_id",
        "CASE WHEN o_orderkey % 3 = 0 THEN '10.1000/x' || (o_orderkey % 2000) END AS doi",
        "CASE WHEN o_orderkey % 3 <> 2 THEN CAST(30000000 + o_orderkey % 1700 AS STRING) END AS pmid",
        "CASE WHEN o_orderkey % 2 = 0 THEN 'PMC' || (1000000 + o_orderkey % 1600) END AS pmc_id"])


RF = "rf AS (" + REFS.format(orders="orders") + ")"
RESOLVED = ("rr AS (SELECT rf.*, COALESCE(a.id, b.id, c.id) AS referenced_id FROM rf LEFT JOIN pa a ON a.doi = rf.doi "
            "LEFT JOIN pa b ON b.pmid = rf.pmid LEFT JOIN pa c ON c.pmc_id = rf.pmc_id)")


@query("reference_resolution", A.sql(
    "SELECT ref_no, paper_id, referenced_id, referenced_id IS NOT NULL AS in_corpus FROM rr", A.PA, RF, RESOLVED))
def reference_resolution(spark, sf):
    return graph.resolve_references(_refs(spark, sf), A.papers(spark, sf)).select(
        "ref_no", "paper_id", "referenced_id", "in_corpus")


@query("citation_edges", A.sql(
    f"SELECT DISTINCT referenced_id AS src, paper_id AS dst FROM rr WHERE referenced_id <> paper_id AND referenced_id IN (SELECT id FROM ok) "
    "AND paper_id IN (SELECT id FROM ok)", A.PA, RF, RESOLVED,
    f"ok AS (SELECT id FROM pa WHERE triage_category IN {PASSED} AND xml_path IS NOT NULL)"))
def citation_edges(spark, sf):
    return graph.citation_edges(_refs(spark, sf), A.papers(spark, sf)).select("src", "dst")


EDGES = ("ed AS (SELECT DISTINCT CAST(floor(doc_id / k) AS BIGINT) AS src, doc_id AS dst FROM documents, (VALUES (2), (3), (5)) t(k) "
         "WHERE doc_id > 0)")


def _doc_edges(spark, sf):
    d = table(spark, sf, "documents").where("doc_id > 0")
    return d.select(F.explode(F.array(*[F.expr(f"CAST(floor(doc_id / {k}) AS BIGINT)") for k in (2, 3, 5)])).alias("src"),
                    F.col("doc_id").alias("dst"))


LEVELS = ("WITH RECURSIVE " + EDGES + ", lv(id, level) AS (SELECT doc_id, 0 FROM documents UNION "
          "SELECT ed.dst, lv.level + 1 FROM lv JOIN ed ON ed.src = lv.id) ")


@query("topo_levels", LEVELS + "SELECT id, CAST(MAX(level) AS INTEGER) AS level FROM lv GROUP BY id")
def topo_levels(spark, sf):
    nodes = table(spark, sf, "documents").select(F.col("doc_id").alias("id"))
    return graph.topological_levels(_doc_edges(spark, sf), nodes)


@query("processing_order", LEVELS + "SELECT id, CAST(ROW_NUMBER() OVER (ORDER BY level, id) - 1 AS INTEGER) AS processing_priority FROM "
       "(SELECT id, MAX(level) AS level FROM lv GROUP BY id) q")
def processing_order(spark, sf):
    nodes = table(spark, sf, "documents").select(F.col("doc_id").alias("id"))
    return graph.processing_order(_doc_edges(spark, sf), nodes)


RINGS = ("e AS (SELECT a.doc_id AS src, b.doc_id AS dst FROM documents a JOIN documents b ON b.doc_id = a.doc_id - a.doc_id % 5 + (a.doc_id + 1) % 5 "
         "OR (a.doc_id % 5 = 2 AND a.doc_id % 15 < 10 AND b.doc_id = a.doc_id + 5)), "
         "reach AS (SELECT src, dst FROM e UNION SELECT r.src, e.dst FROM reach r JOIN e ON r.dst = e.src)")


@query("cycles_broken", "WITH RECURSIVE " + RINGS + " SELECT src, dst FROM e WHERE NOT (src > dst AND EXISTS (SELECT 1 FROM reach WHERE reach.src = e.dst AND reach.dst = e.src))")
def cycles_broken(spark, sf):
    """Rings of five documents, three rings in a row joined by one-way edges."""
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("src"))
    ring = d.withColumn("dst", F.expr("src - src % 5 + (src + 1) % 5"))
    onward = d.where("src % 5 = 2 AND src % 15 < 10").withColumn("dst", F.expr("src + 5"))
    edges = ring.unionByName(onward).join(d.withColumnRenamed("src", "dst"), "dst", "left_semi")
    return graph.break_cycles(edges.select("src", "dst"))


# -- search ----------------------------------------------------------------------------------------------------

FOUND = ("SELECT pa.id AS paper_id, pa.pmc_id, pa.doi, pa.title, pr.id AS protocol_id, pr.protocol_arm, pr.extraction_confidence "
         "FROM pa JOIN pr ON pr.paper_id = pa.id WHERE {where} ORDER BY paper_id, protocol_id LIMIT 5")


@query("search_corpus_doi", A.sql(FOUND.format(where="pa.doi = '10.1000/x7'"), A.PA, A.PR))
def search_corpus_doi(spark, sf):
    return search.search_corpus(A.papers(spark, sf), A.protocols(spark, sf), "https://doi.org/10.1000/x7")


@query("search_corpus_title", A.sql(FOUND.format(where="pa.title ILIKE '%customer#%1%'"), A.PA, A.PR))
def search_corpus_title(spark, sf):
    return search.search_corpus(A.papers(spark, sf), A.protocols(spark, sf), "customer#%1")


@query("reference_texts", A.sql(
    "SELECT doi, pmid, CASE WHEN EXISTS (SELECT 1 FROM documents d WHERE '10.1000/x' || d.doc_id = q.doi AND d.doc_id % 2 = 0) THEN 'cache' "
    "WHEN EXISTS (SELECT 1 FROM documents d WHERE d.doc_id % 2 = 1 AND ('10.1000/x' || d.doc_id = q.doi OR CAST(30000000 + d.doc_id AS VARCHAR) = q.pmid)) "
    "THEN 'in_corpus' ELSE 'fetch' END AS source, (SELECT MAX(md5(d.text)) FROM documents d WHERE (d.doc_id % 2 = 0 AND '10.1000/x' || d.doc_id = q.doi) "
    "OR (d.doc_id % 2 = 1 AND '10.1000/x' || d.doc_id = q.doi) OR (d.doc_id % 2 = 1 AND CAST(30000000 + d.doc_id AS VARCHAR) = q.pmid "
    "AND NOT EXISTS (SELECT 1 FROM documents e WHERE '10.1000/x' || e.doc_id = q.doi))) AS digest FROM q",
    "q AS (SELECT DISTINCT CASE WHEN o_orderkey % 3 = 0 THEN '10.1000/x' || (o_orderkey % 2000) END AS doi, "
    "CAST(30000000 + o_orderkey % 1700 AS VARCHAR) AS pmid FROM orders)"))
def reference_texts(spark, sf):
    asked = table(spark, sf, "orders").selectExpr(
        "CASE WHEN o_orderkey % 3 = 0 THEN '10.1000/x' || (o_orderkey % 2000) END AS doi",
        "CAST(30000000 + o_orderkey % 1700 AS STRING) AS pmid").distinct()
    d = table(spark, sf, "documents")
    cache = d.where("doc_id % 2 = 0").selectExpr("'10.1000/x' || doc_id AS doi", "'t' AS title", "text AS full_text")
    corpus = d.where("doc_id % 2 = 1").selectExpr(
        "doc_id AS id", "'10.1000/x' || doc_id AS doi", "CAST(30000000 + doc_id AS STRING) AS pmid", "'t' AS title", "text AS full_text")
    return search.reference_texts(asked, cache, corpus).select(
        "doi", "pmid", "source", F.md5("text").alias("digest"))


# -- statistics and audit --------------------------------------------------------------------------------------

@query("stats_counters", A.sql(
    "SELECT 'total_papers' AS metric, COUNT(*) AS value FROM pa UNION ALL SELECT 'papers_with_text', COUNT(parsed_text_path) FROM pa "
    "UNION ALL SELECT 'geo_papers_linked', COUNT(*) FROM pa WHERE geo_status = 'linked' UNION ALL SELECT 'rnaseq_checked', COUNT(rnaseq_status) FROM pa "
    "UNION ALL SELECT 'rnaseq_papers', COUNT(*) FROM pa WHERE rnaseq_status = 'has_rnaseq' UNION ALL SELECT 'protocols_extracted', COUNT(*) FROM pr "
    "UNION ALL SELECT 'expression_values_count', COUNT(*) FROM ev UNION ALL SELECT 'expression_genes', COUNT(DISTINCT gene_symbol) FROM ev "
    "UNION ALL SELECT 'expression_papers', COUNT(DISTINCT paper_id) FROM ev UNION ALL SELECT 'geo_samples_total', COUNT(*) FROM sa", A.PA, A.PR, A.EV, A.SA))
def stats_counters(spark, sf):
    return stats.counters(A.papers(spark, sf), A.protocols(spark, sf), A.values(spark, sf), samples=A.samples(spark, sf))


@query("stats_by_category", A.sql("SELECT triage_category, COUNT(*) AS n FROM pa GROUP BY 1", A.PA))
def stats_by_category(spark, sf):
    return stats.by_category(A.papers(spark, sf))


@query("stats_by_status", A.sql(
    f"SELECT extraction_status, COUNT(*) AS n FROM pa WHERE triage_category IN {PASSED} GROUP BY 1", A.PA))
def stats_by_status(spark, sf):
    return stats.by_status(A.papers(spark, sf))


@query("triage_histogram",
       "SELECT category, n, ROUND(100.0 * n / (SELECT COUNT(*) FROM labels), 6) AS percent FROM (SELECT CASE quality WHEN 1 THEN 'primary_protocol' "
       "ELSE 'review' END AS category, COUNT(*) AS n FROM labels GROUP BY 1 UNION ALL SELECT 'errors', COUNT(*) FROM labels WHERE toxic = 1 "
       "HAVING COUNT(*) > 0) q")
def triage_histogram(spark, sf):
    log = table(spark, sf, "labels").selectExpr(
        "CASE quality WHEN 1 THEN 'primary_protocol' ELSE 'review' END AS category", "CASE WHEN toxic = 1 THEN 'api_error' END AS error")
    return rounded(stats.triage_histogram(log), "percent")


BUCKET = ("CASE WHEN COALESCE({c}, 0) >= 0.85 AND COALESCE({c}, 0) < 1.01 THEN 'high' WHEN COALESCE({c}, 0) >= 0.70 AND COALESCE({c}, 0) < 0.85 THEN 'good' "
          "WHEN COALESCE({c}, 0) >= 0.50 AND COALESCE({c}, 0) < 0.70 THEN 'fair' ELSE 'low' END")


@query("confidence_bucket", A.sql(
    "SELECT " + BUCKET.format(c="extraction_confidence") + " AS bucket, COUNT(*) AS n FROM pr GROUP BY 1", A.PR))
def confidence_bucket(spark, sf):
    return A.protocols(spark, sf).groupBy(
        audit.confidence_bucket(F.col("extraction_confidence")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query("audit_sample", A.sql(
    "SELECT id, triage_category, bucket FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY triage_category, bucket ORDER BY id * 7919 % 1000003, id) "
    "AS rn FROM (SELECT pr.id, pa.triage_category, " + BUCKET.format(c="pr.extraction_confidence")
    + f" AS bucket FROM pr JOIN pa ON pa.id = pr.paper_id WHERE pa.triage_category IN {PASSED}) q) q WHERE rn <= 5", A.PA, A.PR))
def audit_sample(spark, sf):
    s = audit.stratified_sample(A.protocols(spark, sf), A.papers(spark, sf), order=F.expr("id * 7919 % 1000003"))
    return s.select("id", "triage_category", "bucket")


RATED = ("ra AS (SELECT " + BUCKET.format(c="extraction_confidence") + " AS bucket, pa.triage_category AS category, COALESCE(extraction_confidence, 0) AS conf, "
         "CASE pr.id % 6 WHEN 0 THEN 'correct' WHEN 1 THEN 'mostly_correct' WHEN 2 THEN 'partially_correct' WHEN 3 THEN 'incorrect' ELSE 'skip' END AS rating, "
         "CASE pr.id % 6 WHEN 0 THEN 1.0 WHEN 1 THEN 0.75 WHEN 2 THEN 0.5 ELSE 0.0 END AS score FROM pr JOIN pa ON pa.id = pr.paper_id)")


@query("audit_summary", A.sql(
    "SELECT 'overall' AS section, 'all' AS key, ROUND(AVG(score), 6) AS value, COUNT(*) AS n FROM ra WHERE rating <> 'skip' UNION ALL "
    "SELECT 'bucket', bucket, ROUND(AVG(score), 6), COUNT(*) FROM ra WHERE rating <> 'skip' GROUP BY 2 UNION ALL "
    "SELECT 'category', category, ROUND(AVG(score), 6), COUNT(*) FROM ra WHERE rating <> 'skip' GROUP BY 2 UNION ALL "
    "SELECT 'rating', rating, NULL, COUNT(*) FROM ra GROUP BY 2 UNION ALL "
    "SELECT 'confidence', rating, ROUND(AVG(conf), 6), COUNT(*) FROM ra WHERE rating <> 'skip' GROUP BY 2", A.PA, A.PR, RATED))
def audit_summary(spark, sf):
    p = A.papers(spark, sf).select(F.col("id").alias("paper_id"), "triage_category")
    results = A.protocols(spark, sf).join(p, "paper_id").withColumn("rating", F.expr(
        "CASE id % 6 WHEN 0 THEN 'correct' WHEN 1 THEN 'mostly_correct' WHEN 2 THEN 'partially_correct' WHEN 3 THEN 'incorrect' ELSE 'skip' END"))
    return rounded(audit.summary(results), "value")


# -- cross-referencing -----------------------------------------------------------------------------------------

ACCN = ("CASE s_suppkey % 7 WHEN 0 THEN 'GSE' || s_suppkey WHEN 1 THEN 'PRJNA' || s_suppkey WHEN 2 THEN 'ERP' || s_suppkey "
        "WHEN 3 THEN 'E-MTAB-' || s_suppkey WHEN 4 THEN 'DRA' || s_suppkey WHEN 5 THEN 'gsm' || s_suppkey ELSE 'X' || s_suppkey END")
REPO = ("CASE s_suppkey % 7 WHEN 0 THEN 'GEO' WHEN 1 THEN 'SRA' WHEN 2 THEN 'ENA' WHEN 3 THEN 'ArrayExpress' WHEN 4 THEN 'DDBJ' WHEN 5 THEN 'GEO' "
        "ELSE 'unknown' END")


@query("repo_guess", f"SELECT {ACCN} AS accession, {REPO} AS repository FROM supplier")
def repo_guess(spark, sf):
    s = table(spark, sf, "supplier").selectExpr(f"{ACCN} AS accession")
    return s.withColumn("repository", AC.guess_repository(F.col("accession")))


# Extracted accessions: orders by customer. Mined series: the same customers' large orders.
COLLECT = ("ca AS (SELECT paper_id, accession, repository, context, source FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY paper_id, accession ORDER BY prio, "
           "repository, context) AS rn FROM (SELECT o_custkey AS paper_id, 'GSE' || (o_orderkey % 30) AS accession, 0 AS prio, "
           "CASE WHEN o_orderkey % 4 = 0 THEN 'SRA' ELSE 'GEO' END AS repository, 'ambiguous' AS context, 'llm_extraction' AS source FROM orders WHERE o_orderkey % 2 = 0 "
           "UNION ALL SELECT o_custkey, 'GSE' || (o_orderkey % 40), 1, 'GEO', CASE WHEN o_orderkey % 5 = 0 THEN 'own_data' ELSE 'referenced' END, 'geo_discovery' "
           "FROM orders) q) q WHERE rn = 1)")


def _collected(spark, sf):
    o = table(spark, sf, "orders")
    one = o.where("o_orderkey % 2 = 0").selectExpr(
        "o_custkey AS paper_id", "'GSE' || (o_orderkey % 30) AS accession",
        "CASE WHEN o_orderkey % 4 = 0 THEN 'SRA' END AS repository", "CAST(NULL AS STRING) AS context")
    two = o.selectExpr("o_custkey AS paper_id", "'GSE' || (o_orderkey % 40) AS gse_id",
                       "CASE WHEN o_orderkey % 5 = 0 THEN 'own_data' ELSE 'referenced' END AS context")
    return crossref.collect_accessions(one, two)


@query("collect_accessions", A.sql("SELECT * FROM ca", COLLECT))
def collect_accessions(spark, sf):
    return _collected(spark, sf)


@query("availability", A.sql(
    "SELECT paper_id, COUNT(*) AS n_accessions, CASE WHEN BOOL_OR(repository = 'GEO') AND BOOL_OR(COALESCE(m, FALSE)) THEN 'geo_with_matrix' "
    "WHEN BOOL_OR(repository = 'GEO') THEN 'geo_raw_only' WHEN BOOL_OR(repository IN ('ENA', 'SRA')) THEN 'ena_only' ELSE 'no_deposit' END AS classification "
    "FROM ca LEFT JOIN (SELECT 'GSE' || p_partkey AS accession, p_size > 40 AS m FROM part) f USING (accession) GROUP BY 1", COLLECT))
def availability(spark, sf):
    files = table(spark, sf, "part").selectExpr("'GSE' || p_partkey AS accession", "p_size > 40 AS has_count_matrix")
    return crossref.classify_availability(_collected(spark, sf), files)


FILES = ("CASE p_partkey % 6 WHEN 0 THEN 'GSE1_gene_counts.txt.gz' WHEN 1 THEN 'GSE1_RAW.tar' WHEN 2 THEN 'annot' || p_partkey || '.csv' "
         "WHEN 3 THEN 'norm_Expression.xlsx' WHEN 4 THEN 'a.CEL.gz' ELSE 'notes.pdf' END")


@query("file_kinds", f"SELECT p_partkey, {FILES} AS filename, CASE p_partkey % 6 WHEN 0 THEN 'text_table' WHEN 1 THEN 'archive' WHEN 2 THEN 'csv' "
       "WHEN 3 THEN 'excel' WHEN 4 THEN 'microarray_raw' ELSE 'unknown' END AS file_type, p_partkey % 6 IN (0, 3) AS has_count_matrix FROM part")
def file_kinds(spark, sf):
    p = table(spark, sf, "part").selectExpr("p_partkey", f"'ftp://host/suppl/' || {FILES} AS url")
    name = AC.file_name(F.col("url"))
    return p.select("p_partkey", name.alias("filename"), AC.file_type(name).alias("file_type"),
                    AC.has_count_matrix(name).alias("has_count_matrix"))
