"""Worklists, lookups, references, retrieval and records that the other modules do not cover."""

from __future__ import annotations

from pyspark.sql import functions as F

from assaymill.functions import text as T
from assaymill.operators import acquire, crossref, extraction, grounding, manual_fetch, mapping, retrieval, search, stats, upserts, worklists
from assaymill.plans import adapters as A
from assaymill.plans.registry import query
from assaymill.plans.table_queries import table
from assaymill.sources import repositories


@query("not_cached", "SELECT doc_id FROM documents WHERE doc_id % 3 <> 0")
def not_cached(spark, sf):
    d = table(spark, sf, "documents").select("doc_id")
    return repositories.not_cached(d, d.where("doc_id % 3 = 0").union(d.where("doc_id % 6 = 0")), "doc_id")


@query("call_batches", "SELECT count(*) AS n, 40 AS batches FROM documents")
def call_batches(spark, sf):
    b = repositories.batches(table(spark, sf, "documents").select("doc_id"), "doc_id", 40)
    per = b.groupBy("batch").agg(F.count("*").alias("n")).where("batch BETWEEN 0 AND 39")
    return per.agg(F.sum("n").alias("n"), F.lit(40).alias("batches"))


@query("find_paper", A.sql("SELECT id, pmc_id, title FROM pa WHERE id = 7 UNION ALL SELECT id, pmc_id, title FROM pa WHERE pmc_id = 'PMC1000012' "
                           "UNION ALL SELECT id, pmc_id, title FROM pa WHERE doi = '10.1000/x23'", A.PA))
def find_paper(spark, sf):
    p = A.papers(spark, sf).select("id", "pmc_id", "doi", "title")
    found = [worklists.find_paper(p, paper_id=7), worklists.find_paper(p, pmc_id="PMC1000012"), worklists.find_paper(p, doi="10.1000/x23"),
             worklists.find_paper(p)]
    return upserts.union_all(found).drop("doi")


@query("rows_by_gene", A.sql("SELECT id, gene_symbol, value FROM ev WHERE gene_symbol = 'VIM'", A.EV))
def rows_by_gene(spark, sf):
    return worklists.by_key(A.values(spark, sf), "gene_symbol", "VIM").select("id", "gene_symbol", "value")


@query("worklist_manual_fetch", A.sql(
    "SELECT pr.id AS protocol_id, pa.id AS paper_id, pa.pmc_id, pa.title AS paper_title, pr.base_protocol_doi FROM pr JOIN pa ON pa.id = pr.paper_id "
    "WHERE pr.needs_manual_fetch", A.PA, A.PR))
def worklist_manual_fetch(spark, sf):
    p = A.protocols(spark, sf).withColumn("incomplete_flags", F.lit(None).cast("string"))
    return worklists.manual_fetch(A.papers(spark, sf), p).select("protocol_id", "paper_id", "pmc_id", "paper_title", "base_protocol_doi")


MAPS = "mp AS (SELECT event_id AS geo_sample_id, user_id AS protocol_id, event_id % 4 AS stage_number FROM events WHERE event_id % 3 = 0)"


@query("mapped_samples", A.sql("SELECT mp.geo_sample_id, mp.stage_number, sa.gsm_id, sa.sample_title, 'SRS' || sa.id AS sra_accession FROM mp JOIN sa ON sa.id = mp.geo_sample_id", A.SA, MAPS))
def mapped_samples(spark, sf):
    m = table(spark, sf, "events").where("event_id % 3 = 0").selectExpr("event_id AS geo_sample_id", "event_id % 4 AS stage_number")
    s = A.samples(spark, sf).withColumn("sra_accession", F.concat(F.lit("SRS"), F.col("id")))
    return mapping.mapped_samples(m, s).select("geo_sample_id", "stage_number", "gsm_id", "sample_title", "sra_accession")


@query("model_mapping", A.sql(
    "SELECT sa.id AS geo_sample_id, sa.geo_accession_id AS protocol_id, COALESCE(rg.stage_name, '') AS stage_name, CAST(sa.id % 6 AS INTEGER) AS stage_number, "
    "CAST(CASE WHEN sa.id % 2 = 0 THEN 0.9 ELSE 0.6 END AS DOUBLE) AS mapping_confidence FROM sa JOIN (SELECT DISTINCT id FROM pr) p ON p.id = sa.geo_accession_id "
    "JOIN (SELECT DISTINCT protocol_id FROM st) s ON s.protocol_id = p.id LEFT JOIN rg ON rg.protocol_id = p.id AND rg.stage_number = sa.id % 6 WHERE sa.id % 5 <> 0",
    A.SA, A.PR, A.ST, A.RG))
def model_mapping(spark, sf):
    s = A.samples(spark, sf).withColumn("protocol_id", F.col("geo_accession_id"))
    ranges = mapping.with_ranges(A.staged_protocols(spark, sf)).select(F.col("id").alias("protocol_id"), "ranges")
    answers = s.where("id % 5 <> 0").selectExpr(
        "protocol_id", "gsm_id", "CAST(id % 6 AS INT) AS stage_number", "CAST(NULL AS INT) AS time_point_day", "CAST(NULL AS STRING) AS condition_label",
        "CASE WHEN id % 2 = 0 THEN 0.9D END AS confidence")
    return mapping.tier2(s.join(ranges, "protocol_id"), answers).select("geo_sample_id", "protocol_id", "stage_name", "stage_number", "mapping_confidence")


@query("flag_references",
       "SELECT doc_id AS flag_id, CASE doc_id % 4 WHEN 0 THEN '10.1/a' || doc_id WHEN 1 THEN '10.1/b' || doc_id WHEN 2 THEN NULL ELSE '10.1/b' || doc_id END AS doi FROM documents")
def flag_references(spark, sf):
    d = table(spark, sf, "documents")
    flags = d.selectExpr("doc_id AS flag_id", "'p' || doc_id AS path",
                         "CASE doc_id % 4 WHEN 0 THEN 'as in Miller et al. (2011)' WHEN 1 THEN 'see [12] and ' || lang WHEN 2 THEN 'Nobody 1999, ' || source ELSE 'Ref. 12' END AS details")
    refs = d.selectExpr("'p' || doc_id AS path", "inline(array(named_struct('doi', '10.1/a' || doc_id, 'year', '2011', 'label', '3', 'ref_no', 0, 'first_author_surname', 'Miller'), "
                        "named_struct('doi', '10.1/b' || doc_id, 'year', '2012', 'label', '12', 'ref_no', 1, 'first_author_surname', 'Miller')))")
    return manual_fetch.resolve_details(flags, refs)


@query("match_files",
       "SELECT filename, id, doi FROM (SELECT 'f' AS k, CASE doc_id % 3 WHEN 0 THEN '10.1__q' || doc_id || 'q.pdf' WHEN 1 THEN 'scan q' || doc_id || 'q final.pdf' ELSE 'other' || doc_id || '.pdf' END AS filename, "
       "'r' || doc_id AS id, '10.1/q' || doc_id || 'q' AS doi, doc_id FROM documents) q WHERE doc_id % 3 <> 2")
def match_files(spark, sf):
    d = table(spark, sf, "documents")
    f = d.selectExpr("CASE doc_id % 3 WHEN 0 THEN '10.1__q' || doc_id || 'q.pdf' WHEN 1 THEN 'scan q' || doc_id || 'q final.pdf' ELSE 'other' || doc_id || '.pdf' END AS filename")
    refs = d.selectExpr("'r' || doc_id AS id", "'10.1/q' || doc_id || 'q' AS doi", "'10.1__q' || doc_id || 'q.pdf' AS suggested_filename")
    return manual_fetch.match_files(f, refs)


@query("papers_to_extract", A.sql("SELECT DISTINCT paper_id FROM pr WHERE id % 4 = 0 AND id % 100 % 3 = 0", A.PR))
def papers_to_extract(spark, sf):
    p = A.protocols(spark, sf)
    wanted = p.where("id % 4 = 0").selectExpr("'k' || (id % 100) AS key", "id AS protocol_id")
    refs = wanted.selectExpr("key", "CASE WHEN CAST(substr(key, 2) AS INT) % 3 = 0 THEN 'ingested' ELSE 'pending' END AS status").distinct()
    return manual_fetch.papers_to_extract(wanted, refs, p)


@query("ingested_references", "SELECT 'r' || doc_id AS id, CASE WHEN length(trim(text)) >= 100 AND doc_id % 5 <> 0 OR doc_id % 5 = 0 THEN 'ingested' ELSE 'pending' END AS status FROM documents")
def ingested_references(spark, sf):
    d = table(spark, sf, "documents")
    matched = d.selectExpr("'f' || doc_id AS filename", "'r' || doc_id AS id", "'10.1/' || doc_id AS doi")
    refs = d.selectExpr("'r' || doc_id AS id", "CASE WHEN doc_id % 5 = 0 THEN 'ingested' ELSE 'pending' END AS status")
    return manual_fetch.ingest(matched, d.selectExpr("'f' || doc_id AS filename", "text"), refs)[1].select("id", "status")


@query("availability_counts", "SELECT CASE c_custkey % 4 WHEN 0 THEN 'geo_with_matrix' WHEN 1 THEN 'geo_raw_only' WHEN 2 THEN 'ena_only' ELSE 'no_deposit' END AS classification, COUNT(*) AS n FROM customer GROUP BY 1")
def availability_counts(spark, sf):
    c = table(spark, sf, "customer").selectExpr(
        "CASE c_custkey % 4 WHEN 0 THEN 'geo_with_matrix' WHEN 1 THEN 'geo_raw_only' WHEN 2 THEN 'ena_only' ELSE 'no_deposit' END AS classification")
    return stats.classification_counts(c)


@query("markers_by_paper", A.sql(
    "SELECT pa.pmc_id, COUNT(*) AS n, CAST(SUM(ev.value) AS DECIMAL(38, 2)) AS total FROM ev JOIN pa ON pa.id = ev.paper_id GROUP BY 1", A.EV, A.PA))
def markers_by_paper(spark, sf):
    m = retrieval.markers_by_paper(A.values(spark, sf), A.papers(spark, sf))
    value = F.get_json_object("marker", "$.value").cast("double")
    return m.groupBy("pmc_id").agg(F.count("*").alias("n"), F.sum(value).cast("decimal(38,2)").alias("total"))


@query("first_protocols", A.sql("SELECT paper_id, MIN(id) AS protocol_id FROM pr GROUP BY 1", A.PR))
def first_protocols(spark, sf):
    return retrieval.first_protocol(A.protocols(spark, sf))


@query("retrieval_waterfall", A.sql(
    "SELECT paper_id, id, CASE WHEN paper_id % 3 = 0 THEN 'matrix' WHEN paper_id % 3 = 1 THEN 'supplement' ELSE 'text' END AS tier FROM ev "
    "WHERE (paper_id % 3 = 0 AND id % 2 = 0) OR (paper_id % 3 = 1 AND id % 3 = 0) OR (paper_id % 3 = 2 AND id % 5 = 0)", A.EV))
def retrieval_waterfall(spark, sf):
    v = A.values(spark, sf).select("paper_id", "id")

    def tier(name, rule):
        return lambda keys: v.where(rule).join(keys, "paper_id", "left_semi").withColumn("tier", F.lit(name))
    return acquire.staged(v, ["paper_id"], [tier("matrix", "paper_id % 3 = 0 AND id % 2 = 0"), tier("supplement", "paper_id % 3 < 2 AND id % 3 = 0"),
                                            tier("text", "id % 5 = 0")])


@query("candidate_files", "SELECT doc_id % 50 AS gse_id, CASE doc_id % 3 WHEN 0 THEN 'raw_counts_' || doc_id || '.csv.gz' ELSE 'm' || doc_id || '.txt.gz' END AS filename FROM documents "
       "WHERE (doc_id % 3 = 0) OR doc_id % 50 NOT IN (SELECT doc_id % 50 FROM documents WHERE doc_id % 3 = 0)")
def candidate_files(spark, sf):
    f = table(spark, sf, "documents").selectExpr(
        "doc_id % 50 AS gse_id", "CASE doc_id % 3 WHEN 0 THEN 'raw_counts_' || doc_id || '.csv.gz' ELSE 'm' || doc_id || '.txt.gz' END AS filename", "n_chars * 1000000 AS size")
    return retrieval.candidate_files(f).select("gse_id", "filename")


@query("append_rows", "SELECT doc_id, COALESCE(CASE WHEN doc_id % 4 = 1 THEN source END, CASE WHEN doc_id % 4 < 2 THEN 'new' END) AS status FROM documents WHERE doc_id % 4 < 3")
def append_rows(spark, sf):
    d = table(spark, sf, "documents")
    old = d.where("doc_id % 4 = 2").selectExpr("doc_id", "CAST(NULL AS STRING) AS status")
    new = d.where("doc_id % 4 < 2").selectExpr("doc_id", "CASE WHEN doc_id % 4 = 1 THEN source END AS status")
    return upserts.append_rows(old, new, {"status": "new"})


@query("append_absent", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'old' ELSE 'new' END AS state FROM documents")
def append_absent(spark, sf):
    d = table(spark, sf, "documents").select("doc_id")
    return upserts.append_absent(d.where("doc_id % 3 = 0").withColumn("state", F.lit("old")), d.withColumn("state", F.lit("new")), ["doc_id"])


@query("delete_protocols", A.sql("SELECT id FROM pr WHERE paper_id % 3 <> 0", A.PR))
def delete_protocols(spark, sf):
    gone = A.papers(spark, sf).where("id % 3 = 0").selectExpr("id AS paper_id")
    return upserts.delete_protocols(A.protocols(spark, sf), gone.union(gone)).select("id")


@query("retry_errors", "SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'parse_failed' ELSE 'api_error: ' || source END AS error FROM documents WHERE doc_id % 5 IN (0, 3)")
def retry_errors(spark, sf):
    d = table(spark, sf, "documents").selectExpr(
        "doc_id", "CASE doc_id % 5 WHEN 0 THEN 'parse_failed' WHEN 1 THEN 'no_abstract' WHEN 3 THEN 'api_error: ' || source END AS error")
    return extraction.retry_errors(d)


@query("methods_part", "SELECT doc_id, md5(CASE WHEN doc_id % 2 = 0 THEN '## Methods' || chr(10) || text ELSE 'Intro ' || text END) AS digest FROM documents")
def methods_part(spark, sf):
    d = table(spark, sf, "documents").selectExpr("doc_id", "CASE WHEN doc_id % 2 = 0 THEN 'Before' || chr(10) || '## Methods' || chr(10) || text ELSE 'Intro ' || text END AS t")
    return d.select("doc_id", F.md5(T.methods_snippet(F.col("t"))).alias("digest"))


@query("repository_status", "SELECT doc_id AS paper_id, CASE WHEN doc_id % 4 < 2 THEN 'fetched' WHEN doc_id % 4 = 2 THEN 'not_found' ELSE 'unsupported_repository' END AS fetch_status, "
       "doc_id % 4 = 0 AS has_processed_matrix, CASE WHEN doc_id % 4 = 0 THEN 'T ' || source END AS project_title FROM documents")
def repository_status(spark, sf):
    d = table(spark, sf, "documents")
    acc = d.selectExpr("doc_id AS paper_id", "'A' || doc_id AS accession", "CASE doc_id % 4 WHEN 0 THEN 'GEO' WHEN 1 THEN 'ENA' WHEN 2 THEN 'SRA' ELSE 'Zenodo' END AS repository")
    series = d.where("doc_id % 4 = 0").selectExpr("'A' || doc_id AS accession", "'T ' || source AS title", "lang AS organism", "'rna' AS data_type", "'GPL1' AS platform", "'3' AS sample_count")
    runs = d.where("doc_id % 4 = 1").selectExpr("'A' || doc_id AS accession", "lang AS organism", "'rna' AS data_type", "'x' AS platform", "4 AS sample_count")
    files = series.select("accession", F.lit(True).alias("has_count_matrix"))
    return crossref.repository_records(acc, series, runs, files).select("paper_id", "fetch_status", "has_processed_matrix", "project_title")


@query("stored_availability", "SELECT doc_id AS paper_id, CASE WHEN doc_id % 3 <> 0 THEN lang END AS classification FROM documents")
def stored_availability(spark, sf):
    d = table(spark, sf, "documents")
    a = d.where("doc_id % 3 <> 0").selectExpr("doc_id AS paper_id", "lang AS classification", "doc_id % 7 AS n_accessions")
    out = crossref.store_availability(d.selectExpr("doc_id AS paper_id", "CAST(NULL AS STRING) AS data_availability"), a)
    return out.select("paper_id", "data_availability.classification")


@query("study_records", "SELECT doc_id AS accession, 'Study ' || source AS project_title, CAST(doc_id % 4 AS INTEGER) AS sample_count FROM documents WHERE doc_id % 9 <> 0")
def study_records(spark, sf):
    links = "CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN '\"a\"' WHEN 2 THEN '\"a\",\"b\"' ELSE '\"a\",\"b\",\"c\"' END"
    a = table(spark, sf, "documents").selectExpr("doc_id AS accession", "CASE WHEN doc_id % 9 = 0 THEN NULL ELSE '{\"title\":\"Study ' || source || '\",\"section\":{\"subsections\":["
                                                 f"{{\"type\":\"Samples\",\"links\":[' || {links} || ']}}]}}}}' END AS answer")
    return repositories.study_from_json(a)


@query("linked_series", "SELECT doc_id AS paper_id, 'GSE' || (5000 + doc_id) AS accession, 'About ' || source AS title FROM documents UNION ALL SELECT doc_id, 'GSE' || (7000 + doc_id), '' FROM documents WHERE doc_id % 2 = 0")
def linked_series(spark, sf):
    a = table(spark, sf, "documents").selectExpr(
        "doc_id AS paper_id", "'<DocumentSummary uid=\"1\"><Accession>GSE' || (5000 + doc_id) || '</Accession><title>About ' || source || '</title></DocumentSummary>' || "
        "CASE WHEN doc_id % 2 = 0 THEN ' see GSE' || (7000 + doc_id) || ' ' ELSE '' END AS answer")
    return repositories.linked_series(a)


@query("cached_search", "SELECT doi, title FROM (SELECT DISTINCT '10.1/' || doc_id AS doi, 'T ' || lang || ' ' || doc_id AS title FROM documents) q WHERE title ILIKE '%T de%' ORDER BY doi, title LIMIT 5")
def cached_search(spark, sf):
    c = table(spark, sf, "documents").selectExpr("'10.1/' || doc_id AS doi", "CAST(NULL AS STRING) AS pmc_id", "'T ' || lang || ' ' || doc_id AS title", "text AS full_text")
    return search.search_cache(c, "T de").select("doi", "title")


@query("removed_terms", "SELECT category, term, COUNT(*) AS n FROM (SELECT lang AS category, source AS term FROM documents WHERE doc_id % 2 = 0) q GROUP BY 1, 2")
def removed_terms(spark, sf):
    d = table(spark, sf, "documents").where("doc_id % 2 = 0").selectExpr(
        "doc_id AS id", "array(named_struct('category', lang, 'term', source, 'stage', 'S', 'reason', 'x')) AS removals")
    return grounding.top_removed(grounding.removal_counts(d))


@query("coalesced_answers", "SELECT o_orderkey, CASE WHEN o_custkey % 2 = 0 THEN c_name WHEN o_custkey % 7 <> 0 THEN reverse(CAST(o_custkey AS VARCHAR)) END AS answer "
                            "FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def coalesced_answers(spark, sf):
    def service(key):
        if int(key) % 7 == 0:
            raise OSError("no answer")
        return key[::-1]
    wants = table(spark, sf, "orders").selectExpr("o_orderkey", "CAST(o_custkey AS STRING) AS key")
    known = table(spark, sf, "customer").where("c_custkey % 2 = 0").selectExpr("CAST(c_custkey AS STRING) AS key", "c_name AS answer")
    return repositories.answered(wants, "key", known, service)[0].select("o_orderkey", "answer")
