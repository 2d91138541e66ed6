"""Accession mining, grounding, budgets, markdown, markup."""

from __future__ import annotations

from pyspark.sql import functions as F

from assaymill.functions import text as T
from assaymill.operators import discovery, documents, grounding, supplements
from assaymill.plans import adapters as A
from assaymill.plans.registry import query
from assaymill.plans.table_queries import table
from assaymill.sources.xml import shred

# Texts with accessions: a document with two series of its own worked into its start and end.
TEXT = ("'See GSE' || (10000 + doc_id % 500) || ' and xGSE99999. ' || text || ' Also E-MTAB-' || doc_id || ', GSE' || (20000 + doc_id) "
        "|| ' (GSE' || (10000 + doc_id % 500) || ').'")
MINED = ("mi AS (SELECT doc_id AS paper_id, 'GSE' || (10000 + doc_id % 500) AS accession, 0 AS pos FROM documents UNION ALL "
         "SELECT doc_id, 'E-MTAB-' || doc_id, 1 FROM documents UNION ALL SELECT doc_id, 'GSE' || (20000 + doc_id), 2 FROM documents)")


def _texts(spark, sf):
    return table(spark, sf, "documents").selectExpr("doc_id AS paper_id", f"{TEXT} AS text")


@query("mine_accessions", A.sql(
    "SELECT mi.paper_id, mi.accession, 'own_data' AS context, 'supplement' AS source, mi.pos, trim(substr(t, greatest(1, p - 100), "
    "p + length(mi.accession) + 100 - greatest(1, p - 100))) AS surrounding_text FROM (SELECT mi.*, d.t, CASE mi.pos WHEN 0 THEN 5 "
    "WHEN 1 THEN length(d.t) - strpos(reverse(d.t), '-BATM-E') - 5 ELSE 0 END AS p0, "
    "CASE mi.pos WHEN 0 THEN 5 ELSE strpos(d.t, ' Also E-MTAB-' || mi.paper_id || ', GSE' || (20000 + mi.paper_id)) + CASE mi.pos WHEN 1 THEN 6 "
    "ELSE 6 + length('E-MTAB-' || mi.paper_id) + 2 END END AS p FROM mi JOIN d ON d.paper_id = mi.paper_id) mi",
    MINED, f"d AS (SELECT doc_id AS paper_id, {TEXT} AS t FROM documents)"))
def mine_accessions(spark, sf):
    return discovery.mine_text(_texts(spark, sf))


# Hits of three strategies for overlapping series of a paper.
HITS = ("h AS (SELECT doc_id % 200 AS paper_id, 'GSE' || (1000 + doc_id % 70) AS accession, CASE doc_id % 3 WHEN 0 THEN 'ambiguous' WHEN 1 THEN 'referenced' "
        "ELSE 'own_data' END AS context, CASE doc_id % 4 WHEN 0 THEN 'elink' WHEN 1 THEN 'supplement' ELSE 'xml' END AS source, "
        "text AS surrounding_text FROM documents)")
MERGED = ("r AS (SELECT *, CASE context WHEN 'own_data' THEN 3 WHEN 'referenced' THEN 2 ELSE 1 END AS rk, CASE source WHEN 'xml' THEN 1 WHEN 'supplement' THEN 2 "
          "ELSE 3 END AS nth FROM h), mg AS (SELECT paper_id, accession, arg_min(context, -rk * 10 + nth) AS context, MIN({'r': -rk, 'n': nth, 'c': context, 's': surrounding_text}).s AS words, concat_ws('+', MAX(CASE WHEN source = 'xml' THEN source END), "
          "MAX(CASE WHEN source = 'supplement' THEN source END), MAX(CASE WHEN source = 'elink' THEN source END)) AS source, COUNT(DISTINCT source) AS ns FROM r GROUP BY 1, 2)")


def _hits(spark, sf):
    return table(spark, sf, "documents").selectExpr(
        "doc_id % 200 AS paper_id", "'GSE' || (1000 + doc_id % 70) AS accession",
        "CASE doc_id % 3 WHEN 0 THEN 'ambiguous' WHEN 1 THEN 'referenced' ELSE 'own_data' END AS context",
        "CASE doc_id % 4 WHEN 0 THEN 'elink' WHEN 1 THEN 'supplement' ELSE 'xml' END AS source", "text AS surrounding_text")


@query("merge_hits", A.sql(
    "SELECT paper_id, accession, context, source, md5(words) AS digest FROM mg", HITS, MERGED))
def merge_hits(spark, sf):
    return discovery.merge_hits(_hits(spark, sf)).select(
        "paper_id", "accession", "context", "source", F.md5("surrounding_text").alias("digest"))


@query("hit_confidence", A.sql(
    "SELECT mg.paper_id, accession AS gse_id, CASE WHEN f.own THEN 'own_data' ELSE context END AS context, COALESCE(f.ok, FALSE) AS soft_fetched, "
    "CAST(LEAST(100, CASE WHEN f.own OR context = 'own_data' THEN 80 WHEN context = 'referenced' THEN 60 ELSE 50 END + CASE WHEN ns >= 2 THEN 10 ELSE 0 END + "
    "CASE WHEN BOOL_OR(COALESCE(f.ok, FALSE)) OVER (PARTITION BY mg.paper_id) THEN 5 ELSE 0 END) AS DOUBLE) / 100 AS confidence FROM mg LEFT JOIN "
    "(SELECT 'GSE' || (1000 + n) AS accession, TRUE AS ok, n FROM range(0, 70, 2) t(n)) f0 USING (accession) LEFT JOIN LATERAL (SELECT f0.ok AS ok, "
    "f0.ok AND mg.paper_id % 10 = f0.n % 10 AS own) f ON TRUE", HITS, MERGED))
def hit_confidence(spark, sf):
    # A series record exists for every second series; it names the papers with its last digit.
    d = table(spark, sf, "documents")
    series = d.where("doc_id % 70 % 2 = 0").selectExpr(
        "'GSE' || (1000 + doc_id % 70) AS accession", "array(CAST(doc_id % 70 % 10 AS STRING)) AS linked_pmids").distinct()
    papers = d.selectExpr("doc_id % 200 AS id", "CAST(doc_id % 200 % 10 AS STRING) AS pmid").distinct()
    h = discovery.score_hits(discovery.merge_hits(_hits(spark, sf)), series, papers)
    return h.select("paper_id", "gse_id", "context", "soft_fetched", "confidence")


# Terms of a paper: the start of its own text, a benchmark passage, short words, nothing, a term with aliases.
TERMS = ("te AS (SELECT doc_id AS paper_id, left(text, 25) AS term, NULL AS alias, text FROM documents UNION ALL "
         "SELECT doc_id, b.text, NULL, d.text FROM documents d JOIN benchmark b ON b.item_id = d.doc_id % 40 UNION ALL "
         "SELECT doc_id, 'The', NULL, text FROM documents UNION ALL SELECT doc_id, 'er', NULL, text FROM documents UNION ALL "
         "SELECT doc_id, '', NULL, text FROM documents UNION ALL SELECT doc_id, 'AND', 'die', text FROM documents)")
WORD = "regexp_matches(lower(text), '(^|[^\\p{{L}}\\p{{N}}_]){w}($|[^\\p{{L}}\\p{{N}}_])')"


@query("ground_terms", A.sql(
    "SELECT paper_id, term, CASE WHEN term = '' THEN TRUE WHEN alias IS NOT NULL THEN " + WORD.format(w="die")
    + " OR " + WORD.format(w="and") + " WHEN term = 'The' THEN " + WORD.format(w="the") + " WHEN term = 'er' THEN " + WORD.format(w="er")
    + " ELSE contains(lower(text), lower(term)) END AS grounded FROM te", TERMS))
def ground_terms(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("paper_id"), "text")
    b = table(spark, sf, "benchmark").select("item_id", F.col("text").alias("term"))
    none = F.lit(None).cast("array<string>").alias("aliases")
    own = d.select("paper_id", F.explode(F.array(
        F.left("text", F.lit(25)), F.lit("The"), F.lit("er"), F.lit(""), F.lit("AND"))).alias("term"))
    own = own.withColumn("aliases", F.when(F.col("term") == "AND", F.array(F.lit("die"), F.lit("and"))))
    passages = d.select("paper_id", (F.col("paper_id") % 40).alias("item_id")).join(b, "item_id").select(
        "paper_id", "term", none)
    return grounding.terms_in_text(own.unionByName(passages), d).select("paper_id", "term", "grounded")


# Protocols whose stage reagents are checked against the document of the same number.
@query("ground_protocols",
       "SELECT doc_id AS protocol_id, category, term, stage FROM (SELECT doc_id, 'growth_factor' AS category, 'And' AS term, 'S1' AS stage, "
       + WORD.format(w="and") + " AS g FROM documents UNION ALL SELECT doc_id, 'small_molecule', 'tion', 'S1', contains(lower(text), 'tion') FROM documents "
       "UNION ALL SELECT doc_id, 'marker', 'MK', 'S2', contains(lower(text), 'erst') OR " + WORD.format(w="et") + " FROM documents UNION ALL "
       "SELECT doc_id, 'marker', 'ueber', 'endpoint', contains(lower(text), 'ueber') FROM documents) q WHERE NOT g")
def ground_protocols(spark, sf):
    return grounding.removal_report(_grounded(spark, sf)).drop("reason")


def _grounded(spark, sf):
    d = table(spark, sf, "documents")
    reagent = "array<struct<name:string>>"
    marker = "array<struct<marker_name:string>>"
    pr = d.selectExpr(
        "doc_id AS id", "doc_id AS paper_id", "'note' AS extraction_notes",
        f"array(named_struct('stage_name', 'S1', 'growth_factors', array(named_struct('name', 'And'), named_struct('name', '')), 'small_molecules', "
        f"array(named_struct('name', 'tion')), 'stage_markers', CAST(NULL AS {marker})), named_struct('stage_name', 'S2', 'growth_factors', "
        f"CAST(NULL AS {reagent}), 'small_molecules', CAST(array() AS {reagent}), 'stage_markers', array(named_struct('marker_name', 'MK')))) AS stages",
        "named_struct('markers', array(named_struct('marker_name', 'ueber'))) AS endpoint_assessment")
    texts = d.select(F.col("doc_id").alias("paper_id"), "text", F.lit(None).cast("string").alias("supplement_text"))
    tables = {"growth_factor": {}, "small_molecule": {}, "marker": {"MK": ["erst", "et"]}}
    return grounding.ground_protocols(pr, texts, tables)


@query("ground_totals",
       "SELECT COUNT(*) AS checked, COUNT(*) FILTER (WHERE n > 0) AS with_removals, CAST(SUM(n) AS BIGINT) AS removed FROM (SELECT CAST(NOT "
       + WORD.format(w="and") + " AS INTEGER) + CAST(NOT contains(lower(text), 'tion') AS INTEGER) + CAST(NOT (contains(lower(text), 'erst') OR "
       + WORD.format(w="et") + ") AS INTEGER) + CAST(NOT contains(lower(text), 'ueber') AS INTEGER) AS n FROM documents) q")
def ground_totals(spark, sf):
    return grounding.removal_totals(_grounded(spark, sf))


VERIFY = ("v AS (SELECT doc_id AS id, doc_id AS paper_id, 'GSE' || (10000 + doc_id) AS gse_id, CASE WHEN doc_id % 3 = 0 THEN 'xml' "
          "WHEN doc_id % 3 = 1 THEN 'supplement' END AS found_source, doc_id % 7 <> 0 AS has_xml FROM documents), "
          "w AS (SELECT id, paper_id, gse_id, CASE WHEN found_source = 'xml' AND has_xml THEN 'xml' WHEN found_source = 'supplement' THEN 'supplement' END "
          "AS found_source, has_xml FROM v)")


def _verified(spark, sf):
    d = table(spark, sf, "documents")
    acc = d.selectExpr("doc_id AS id", "doc_id AS paper_id", "'GSE' || (10000 + doc_id) AS gse_id")
    texts = d.selectExpr(
        "doc_id AS paper_id", "CASE WHEN doc_id % 7 <> 0 THEN text || CASE WHEN doc_id % 3 = 0 THEN ' GSE' || (10000 + doc_id) ELSE '' END END AS xml",
        "CASE WHEN doc_id % 3 = 1 THEN 'GSE' || (10000 + doc_id) || ' ' || text END AS supplement")
    return grounding.verify_in_text(acc, texts)


@query("text_verification", A.sql(
    "SELECT id, paper_id, gse_id, CASE WHEN found_source IS NULL THEN 'not_in_text' ELSE 'verified' END AS tier1_status, found_source, has_xml FROM w",
    VERIFY))
def text_verification(spark, sf):
    return _verified(spark, sf)


@query("text_verification_totals", A.sql(
    "SELECT COUNT(found_source) AS verified, COUNT(*) - COUNT(found_source) AS hallucinated, COUNT(*) FILTER (WHERE NOT has_xml) AS no_xml, COUNT(*) AS total FROM w",
    VERIFY))
def text_verification_totals(spark, sf):
    return grounding.tier1_totals(_verified(spark, sf))


@query("series_validation", A.sql(
    "SELECT id, CASE WHEN paper_id % 5 <> 4 THEN 'valid' ELSE 'invalid_gse' END AS tier2_status, CASE WHEN paper_id % 5 = 0 THEN 'own_data' "
    "WHEN paper_id % 5 <> 4 THEN 'ambiguous' END AS soft_context FROM w WHERE found_source IS NOT NULL", VERIFY))
def series_validation(spark, sf):
    d = table(spark, sf, "documents")
    series = d.where("doc_id % 5 <> 4").selectExpr(
        "'GSE' || (10000 + doc_id) AS accession", "array(CASE WHEN doc_id % 5 = 0 THEN CAST(doc_id AS STRING) ELSE 'other' END) AS linked_pmids")
    papers = d.selectExpr("doc_id AS id", "CAST(doc_id AS STRING) AS pmid")
    return grounding.validate_series(_verified(spark, sf), series, papers).select("id", "tier2_status", "soft_context")


@query("accession_partition", A.sql(
    "SELECT id, found_source IS NOT NULL AS kept FROM w", VERIFY))
def accession_partition(spark, sf):
    v = _verified(spark, sf)
    kept, doomed = grounding.partition_accessions(v.select("id", "paper_id", "gse_id"), v)
    return kept.select("id", F.lit(True).alias("kept")).unionByName(doomed.select("id", F.lit(False).alias("kept")))


@query("rediscovery",
       "SELECT DISTINCT doc_id AS paper_id, 'GSE' || (CASE n WHEN 0 THEN 10000 + doc_id % 500 ELSE 20000 + doc_id END) AS gse_id FROM documents, range(2) t(n) "
       "WHERE doc_id % 3 = 2 AND NOT (n = 0 AND doc_id % 2 = 0) UNION SELECT doc_id, 'GSE' || (40000 + doc_id) FROM documents WHERE doc_id % 3 = 2")
def rediscovery(spark, sf):
    lost = _texts(spark, sf).where("paper_id % 3 = 2").withColumnRenamed("text", "supplement")
    markup = table(spark, sf, "documents").selectExpr("doc_id AS paper_id", "text || ' GSE' || (40000 + doc_id) AS text")
    markup = discovery.mine_text(markup, source="xml")
    known = table(spark, sf, "documents").where("doc_id % 2 = 0").selectExpr(
        "doc_id AS paper_id", "'GSE' || (10000 + doc_id % 500) AS gse_id")
    return grounding.rediscover(lost, markup, known)


# -- budgets ---------------------------------------------------------------------------------------------------

# A paper per language and source: its documents are sections in id order under recurring titles.
TITLES = ("CASE doc_id % 6 WHEN 0 THEN 'Discussion' WHEN 1 THEN 'Materials and Methods' WHEN 2 THEN 'Results A' WHEN 3 THEN 'Introduction' "
          "WHEN 4 THEN 'Supplementary notes' ELSE 'Conclusion' END")
PRIORITY = "CASE doc_id % 6 WHEN 0 THEN 5 WHEN 1 THEN 0 WHEN 2 THEN 1 WHEN 3 THEN 4 WHEN 4 THEN 3 ELSE 1 END"


@query("budget_fold",
       "WITH RECURSIVE s AS (SELECT floor(doc_id / 8) AS k, ROW_NUMBER() OVER (PARTITION BY floor(doc_id / 8) ORDER BY "
       + PRIORITY + f", doc_id) AS i, {PRIORITY} AS p, '## ' || {TITLES} || chr(10) || text || chr(10) || chr(10) AS b FROM documents), "
       "f AS (SELECT DISTINCT k, CAST(0 AS BIGINT) AS i, '# T' || CAST(k AS BIGINT) || chr(10) || chr(10) || '## Abstract' || chr(10) || 'abs' || chr(10) || chr(10) AS t FROM s "
       "UNION ALL SELECT f.k, s.i, CASE WHEN length(f.t) + length(s.b) <= 9000 THEN f.t || s.b WHEN s.p <= 1 AND 9000 - length(f.t) > 200 THEN "
       "f.t || left(s.b, 9000 - length(f.t) - 50) || chr(10) || chr(10) || '[... truncated ...]' || chr(10) ELSE f.t END FROM f JOIN s ON s.k = f.k AND s.i = f.i + 1) "
       "SELECT CAST(k AS BIGINT) AS k, CAST(length(t) AS INTEGER) AS chars, md5(t) AS digest FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY k ORDER BY i DESC) AS rn FROM f) q WHERE rn = 1")
def budget_fold(spark, sf):
    d = table(spark, sf, "documents").selectExpr(
        "CAST(floor(doc_id / 8) AS BIGINT) AS k", f"named_struct('i', doc_id, 'title', {TITLES}, 'text', text) AS s")
    p = d.groupBy("k").agg(F.array_sort(F.collect_list("s")).alias("sections"))
    p = p.withColumn("title", F.concat(F.lit("T"), F.col("k").cast("string"))).withColumn("abstract", F.lit("abs"))
    t = documents.with_budgeted_text(p, 9000)
    return t.select("k", F.length("full_text").alias("chars"), F.md5("full_text").alias("digest"))


@query("supplement_fold",
       "WITH RECURSIVE s AS (SELECT floor(doc_id / 20) AS k, ROW_NUMBER() OVER (PARTITION BY floor(doc_id / 20) ORDER BY 'f' || doc_id || '.txt') AS i, "
       "chr(10) || '## Supplement: f' || doc_id || '.txt' || chr(10) || chr(10) || regexp_replace(text, '^\\s+|\\s+$', '', 'g') || chr(10) AS b FROM documents "
       "WHERE regexp_replace(text, '^\\s+|\\s+$', '', 'g') <> ''), "
       "f AS (SELECT DISTINCT k, CAST(0 AS BIGINT) AS i, '' AS t, TRUE AS o FROM s UNION ALL SELECT f.k, s.i, CASE WHEN NOT f.o THEN f.t WHEN length(f.t) + length(s.b) <= 40000 "
       "THEN f.t || s.b WHEN 40000 - length(f.t) > 200 THEN f.t || left(s.b, 40000 - length(f.t) - 50) || chr(10) || '[... truncated ...]' || chr(10) ELSE f.t END, "
       "f.o AND length(f.t) + length(s.b) <= 40000 FROM f JOIN s ON s.k = f.k AND s.i = f.i + 1) "
       "SELECT CAST(k AS BIGINT) AS paper_id, CAST(length(t) AS INTEGER) AS chars, md5(t) AS digest FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY k ORDER BY i DESC) AS rn FROM f) q WHERE rn = 1")
def supplement_fold(spark, sf):
    f = table(spark, sf, "documents").selectExpr(
        "CAST(floor(doc_id / 20) AS BIGINT) AS paper_id", "'f' || doc_id || '.txt' AS filename", "text")
    s = supplements.paper_supplements(f, 40_000)
    return s.select("paper_id", F.length("supplement_text").alias("chars"), F.md5("supplement_text").alias("digest"))


@query("supplement_texts",
       "SELECT CAST(floor(doc_id / 20) AS BIGINT) AS paper_id, md5(string_agg(chr(10) || '## Supplement: f' || doc_id || '.txt' || chr(10) || chr(10) || regexp_replace(text, '^\\s+|\\s+$', '', 'g') "
       "|| chr(10), '' ORDER BY 'f' || doc_id || '.txt')) AS digest FROM documents WHERE regexp_replace(text, '^\\s+|\\s+$', '', 'g') <> '' GROUP BY 1")
def supplement_texts(spark, sf):
    f = table(spark, sf, "documents").selectExpr(
        "CAST(floor(doc_id / 20) AS BIGINT) AS paper_id", "'f' || doc_id || '.txt' AS filename", "text")
    return supplements.paper_supplements(f).select("paper_id", F.md5("supplement_text").alias("digest"))


@query("section_class",
       f"SELECT doc_id, {TITLES} AS title, CASE doc_id % 6 WHEN 0 THEN 'discussion' WHEN 1 THEN 'methods' WHEN 2 THEN 'results' WHEN 3 THEN 'introduction' "
       f"WHEN 4 THEN 'supplementary' ELSE 'results' END AS kind, {PRIORITY} AS priority FROM documents")
def section_class(spark, sf):
    d = table(spark, sf, "documents").selectExpr("doc_id", f"{TITLES} AS title")
    return d.withColumn("kind", T.section_class(F.col("title"))).withColumn("priority", T.section_priority(F.col("title")))


@query("markdown_table",
       "SELECT p_brand, '| p_name | p_type | p_size |' || chr(10) || '| --- | --- | --- |' || chr(10) || string_agg('| ' || replace(p_name, ' ', '\\|') || ' | ' || p_type || ' | ' || "
       "CASE WHEN p_size % 5 = 0 THEN '' ELSE CAST(p_size AS VARCHAR) END || ' |', chr(10) ORDER BY p_partkey) AS markdown FROM part GROUP BY p_brand")
def markdown_table(spark, sf):
    p = table(spark, sf, "part").selectExpr(
        "p_partkey", "p_brand", "replace(p_name, ' ', '|') AS p_name", "p_type", "CASE WHEN p_size % 5 <> 0 THEN p_size END AS p_size")
    return supplements.table_markdown(p, ["p_brand"], ["p_partkey"], ["p_name", "p_type", "p_size"])


# -- markup ----------------------------------------------------------------------------------------------------

# An article per document: text as a paragraph with marks, a list, a table, references and an accession.


def articles(spark, sf):
    body = F.regexp_replace("text", r"[^\x09\x0A\x20-\x{D7FF}\x{E000}-\x{FFFD}]", "")
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        body = F.replace(body, F.lit(a), F.lit(b))
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("paper_id"), "source", "lang", body.alias("b"))
    xml = F.concat(
        F.lit('<?xml version="1.0"?><article article-type="research-article" xmlns:xlink="http://www.w3.org/1999/xlink"><front><article-meta>'
              '<article-id pub-id-type="pmcid"> PMC'), F.col("paper_id"), F.lit('</article-id><article-id pub-id-type="doi">10.1/'), F.col("paper_id"),
        F.lit("</article-id><title-group><article-title>Paper <italic>"), F.col("paper_id"), F.lit("</italic></article-title></title-group>"
              "<abstract><p>In <bold>"), F.col("lang"), F.lit("</bold></p></abstract></article-meta></front><body><sec><title>Methods</title><p>A<sup>2</sup> <bold>b</bold> "),
        F.col("b"), F.lit("</p><sec><title>Sub</title><list><list-item>one</list-item><list-item>two</list-item></list></sec></sec><sec><title>Results</title>"
              "<table-wrap><label>T1</label><caption><title>Cap</title></caption><table><tr><th>g</th><th>v|w</th></tr><tr><td>ALB</td></tr></table></table-wrap></sec>"
              "<sec sec-type=\"data-availability\"><title>Data</title><p>Here: GSE"), F.col("paper_id") + 10000, F.lit('</p></sec></body><back><ref-list><ref id="r1"><label>[1].</label>'
              "<element-citation><person-group><name><surname>Doe</surname></name></person-group><article-title>Old GSE"), F.col("paper_id") + 30000,
        F.lit('</article-title><year>2010</year><pub-id pub-id-type="doi">10.9/'), F.col("paper_id") % 7, F.lit("</pub-id></element-citation></ref>"
              "<ref><mixed-citation>nothing here</mixed-citation></ref></ref-list><sec><title>Files</title><p>end</p><supplementary-material xlink:href=\"a/b/s"),
        F.col("paper_id"), F.lit(".csv\"><label>S1</label><caption><p>Sup</p></caption></supplementary-material></sec></back></article>"))
    return d.select("paper_id", F.concat(F.lit("x/PMC"), F.col("paper_id"), F.lit(".xml")).alias("path"), xml.alias("xml"))


def _shredded(spark, sf):
    return shred(articles(spark, sf), partitions=spark.sparkContext.defaultParallelism)


@query("xml_metadata",
       "SELECT 'x/PMC' || doc_id || '.xml' AS path, 'PMC' || doc_id AS pmc_id, '10.1/' || doc_id AS doi, CAST(NULL AS VARCHAR) AS pmid, 'Paper ' || doc_id AS title, "
       "'In ' || lang AS abstract, 'research-article' AS article_type FROM documents")
def xml_metadata(spark, sf):
    return documents.metadata(_shredded(spark, sf).drop("paper_id"))


CLEAN = r"regexp_replace(text, '[^\x{09}\x{0A}\x{20}-\x{FFFD}]', '', 'g')"
PAPER = ("'# Paper ' || doc_id || chr(10) || chr(10) || '## Abstract' || chr(10) || 'In **' || lang || '**' || chr(10) || chr(10) || '## Methods' || chr(10) || chr(10) || '## Methods' || chr(10) || chr(10) || "
         f"regexp_replace('A^2 **b** ' || {CLEAN}, '\\s+$', '') || chr(10) || chr(10) || '### Sub' || chr(10) || '- one' || chr(10) || '- two' || chr(10) || chr(10) || '## Results' || chr(10) || chr(10) || '## Results' || chr(10) || "
         "chr(10) || '**T1** Cap' || chr(10) || chr(10) || '| g | v\\|w |' || chr(10) || '| --- | --- |' || chr(10) || '| ALB |  |' || chr(10) || chr(10) || '## Data' || chr(10) || chr(10) || '## Data' || chr(10) || chr(10) || 'Here: GSE' || (doc_id + 10000) "
         "|| chr(10) || chr(10) || chr(10) || '## Files' || chr(10) || chr(10) || '## Files' || chr(10) || chr(10) || 'end' || chr(10) || chr(10) || chr(10)")


@query("xml_full_text",
       f"SELECT 'PMC' || doc_id AS pmc_id, CAST(length(t) AS INTEGER) AS char_count, md5(t) AS digest, TRUE AS has_methods, 1 AS tables_found FROM (SELECT doc_id, {PAPER} AS t FROM documents) q")
def xml_full_text(spark, sf):
    p = documents.papers_text(_shredded(spark, sf).drop("paper_id"))
    return p.select("pmc_id", "char_count", F.md5("full_text").alias("digest"), "has_methods", "tables_found")


@query("xml_references",
       "SELECT 'x/PMC' || doc_id || '.xml' AS path, '10.9/' || (doc_id % 7) AS doi, 'Old GSE' || (doc_id + 30000) AS title, 'Doe' AS first_author_surname, '2010' AS year, '1' AS label "
       "FROM documents")
def xml_references(spark, sf):
    return documents.references(_shredded(spark, sf).drop("paper_id")).select(
        "path", "doi", "title", "first_author_surname", "year", "label")


@query("xml_accessions",
       "SELECT doc_id AS paper_id, 'GSE' || (doc_id + 10000) AS accession, 'own_data' AS context FROM documents UNION ALL "
       "SELECT doc_id, 'GSE' || (doc_id + 30000), 'referenced' FROM documents")
def xml_accessions(spark, sf):
    return discovery.mine_markup(_shredded(spark, sf)).select("paper_id", "accession", "context")


@query("xml_supplements",
       "SELECT 'x/PMC' || doc_id || '.xml' AS path, 's' || doc_id || '.csv' AS filename, '.csv' AS extension, 'S1' AS label, 'Sup' AS caption FROM documents")
def xml_supplements(spark, sf):
    return documents.supplement_manifest(_shredded(spark, sf).drop("paper_id"))


@query("xml_article_set",
       "SELECT CAST(doc_id AS VARCHAR) AS pmc_id FROM documents")
def xml_article_set(spark, sf):
    a = articles(spark, sf)
    sets = a.select(F.concat(F.lit("<!DOCTYPE x><pmc-articleset>"), F.regexp_replace("xml", r"<\?xml[^>]*\?>", ""),
                             F.lit("</pmc-articleset>")).alias("raw"))
    return documents.split_article_set(sets).select(F.trim("pmc_id").alias("pmc_id"))
