"""Readers on texts derived from the tables, retrieval, exports, manifests, model answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from assaymill import dims
from assaymill.functions import text as T
from assaymill.functions.reagents import stage_summary
from assaymill.operators import acquire, backfill, crossref, export, extraction, manual_fetch, retrieval
from assaymill.plans import adapters as A
from assaymill.plans.expression_queries import SHOWN, rounded
from assaymill.plans.registry import query
from assaymill.plans.table_queries import table
from assaymill.session import cut, spread
from assaymill.sources import matrix, repositories, soft, tables

# -- series matrices: one file per order, its lines are probes or genes ----------------------------------------

PROBE = "CASE l_linenumber WHEN 1 THEN 'ALB' WHEN 2 THEN 'oct4' WHEN 3 THEN 'x_at' WHEN 4 THEN 'ENSG00000101076.3' ELSE 'p' || l_linenumber END"
# The line of an order with the lowest part number stands for its line number.
ONE_LINE = ("ln AS (SELECT l_orderkey, l_linenumber, MIN(l_quantity) AS q, MIN(l_extendedprice) AS e FROM lineitem GROUP BY 1, 2)")

def _lines(spark, sf):
    return _least(spread(table(spark, sf, "lineitem"), "l_orderkey"))

def _least(rows):
    return rows.groupBy("l_orderkey", "l_linenumber").agg(F.min("l_quantity").alias("q"), F.min("l_extendedprice").alias("e"))

def _row(key):
    """Tab line of a probe: two numbers, one missing cell, one cell too many."""
    return F.concat(F.lit('"'), key, F.lit('"\t'), F.col("q").cast("string"), F.lit("\t"), F.col("e").cast("string"), F.lit("\tNA\t9"))

def _laid_out(rows, heads, ends=()):
    """Lines of one file per order: `heads` above its rows (l_linenumber, line) and `ends` below; texts may be columns of the order."""
    def placed(texts, start):
        return [F.struct(F.lit(start + i).alias("n"), (F.lit(t) if isinstance(t, str) else t).alias("line")) for i, t in enumerate(texts)]
    edges = rows.select("l_orderkey").distinct().select(
        "l_orderkey", F.inline(F.array(*placed(heads, -len(heads)), *placed(ends, 1000))))
    every = rows.select("l_orderkey", F.col("l_linenumber").cast("int").alias("n"), "line").unionByName(edges)
    return every.select(F.col("l_orderkey").alias("path"), F.struct(F.lit(0).cast("bigint").alias("block"), F.col("n").cast("bigint").alias("at")).alias("pos"), "line")

MATRIX_HEAD = ['!Series_title\t"x"', '!Series_platform_id\t"GPL570"', '!Sample_title\t"day 1"\t"day 2"\t"day 3"',
               '!Sample_geo_accession\t"GSM1"\t"GSM2"\t"GSM3"', "!series_matrix_table_begin", '"ID_REF"\t"GSM1"\t"GSM2"\t"GSM3"']

def matrix_lines(spark, sf, key=PROBE):
    """A series matrix per order; a gene row behind the end mark is no part of it."""
    rows = _lines(spark, sf).select("l_orderkey", "l_linenumber", _row(F.expr(key)).alias("line"))
    return _laid_out(rows, MATRIX_HEAD, ["!series_matrix_table_end", '"AFP"\t9\t9\t9'])

SAMPLES3 = "(VALUES ('GSM1', 0), ('GSM2', 1), ('GSM3', 2)) s(sample, k)"
CELL = "CASE k WHEN 0 THEN q WHEN 1 THEN e END"

@query("series_matrix", A.sql(
    "SELECT l_orderkey AS path, CASE l_linenumber WHEN 1 THEN 'ALB' WHEN 2 THEN 'POU5F1' ELSE 'HNF4A' END AS gene_symbol, sample, "
    f"{CELL} AS value FROM ln, {SAMPLES3} WHERE l_linenumber IN (1, 2, 4)", ONE_LINE))
def series_matrix(spark, sf):
    return matrix.gene_cells(matrix.tables(matrix_lines(spark, sf))).drop("gene")

@query("series_matrix_titles",
       "SELECT DISTINCT l_orderkey AS path, sample AS gsm_id, 'day ' || (k + 1) AS title FROM lineitem, " + SAMPLES3)
def series_matrix_titles(spark, sf):
    return matrix.sample_titles(matrix_lines(spark, sf))

series_sql = series_matrix_titles

def _annotations(spark, sf):
    """Lines of a platform annotation that lists a probe per line number of the data."""
    p = table(spark, sf, "lineitem").select(F.col("l_linenumber").cast("bigint").alias("n")).distinct()
    line = F.concat(F.lit("p"), F.col("n").cast("string"), F.lit("\t"), F.when(F.col("n") % 2 == 1, "--- // foo").otherwise("LOC1;alb"),
                    F.lit("\tNM_1 // CYP3A4 // x"))
    heads = spark.createDataFrame([(-3, "#note"), (-2, "!x"), (-1, "ID\tGene Symbol\tgene_assignment")], "n long, line string")
    return p.select("n", line.alias("line")).unionByName(heads).select(F.lit("GPL570").alias("platform"), F.col("n").alias("pos"), "line")

@query("probe_genes", "SELECT DISTINCT 'GPL570' AS platform, 'p' || l_linenumber AS probe, CASE WHEN l_linenumber % 2 = 1 THEN 'CYP3A4' ELSE 'ALB' END AS gene_symbol "
       "FROM lineitem")
def probe_genes(spark, sf):
    return matrix.probe_genes(_annotations(spark, sf))

PROBE_ROWS = ("pb AS (SELECT l_orderkey, l_linenumber, q, e, CASE WHEN l_linenumber % 2 = 1 THEN 'CYP3A4' ELSE 'ALB' END AS gene FROM ln), "
              "bp AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, gene ORDER BY (q + e) / 2 DESC, l_linenumber) AS rn FROM pb)")

@query("best_probe", A.sql(
    f"SELECT l_orderkey AS file, gene AS gene_symbol, 'p' || l_linenumber AS probe, sample, {CELL} AS value FROM bp, {SAMPLES3} WHERE rn = 1",
    ONE_LINE, PROBE_ROWS))
def best_probe(spark, sf):
    probes = cut(matrix.probe_genes(_annotations(spark, sf)))
    series = matrix.tables(matrix_lines(spark, sf, "'p' || l_linenumber"), probes)
    return matrix.cells(retrieval.best_probe(matrix.probe_rows(series, probes))).select("file", "gene_symbol", "probe", "sample", "value")

# -- count tables and differential expression ------------------------------------------------------------------

def _count_lines(spark, sf):
    """A comma table per order: gene names in the second column, a quoted header, an empty cell, a number with a suffix."""
    line = F.concat(F.lit("row,"), F.expr(PROBE), F.lit(","), F.col("q").cast("string"), F.lit(","),
                    F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.col("e").cast("string"), F.lit("d"))).otherwise(F.col("e").cast("string")))
    return _laid_out(_lines(spark, sf).select("l_orderkey", "l_linenumber", line.alias("line")), ['n,gene,"s 1, a",s2'], [""])

@query("count_table", A.sql(
    "SELECT l_orderkey AS path, CASE l_linenumber WHEN 1 THEN 'ALB' WHEN 2 THEN 'POU5F1' ELSE 'HNF4A' END AS gene_symbol, sample, "
    "CASE sample WHEN 's2' THEN CASE WHEN l_linenumber % 2 = 1 THEN e END WHEN 'n' THEN NULL ELSE q END AS value FROM ln, "
    "(VALUES ('n'), ('s 1, a'), ('s2')) s(sample) WHERE l_linenumber IN (1, 2, 4)", ONE_LINE))
def count_table(spark, sf):
    lines = _count_lines(spark, sf)
    return tables.count_cells(tables.panel_rows(lines, tables.profiles(lines))).drop("gene")

@query("supplement_kinds",
       "SELECT DISTINCT l_orderkey AS path, CASE WHEN l_orderkey % 3 = 0 THEN 'deg_list' WHEN l_orderkey % 3 = 1 THEN 'pathway_table' "
       "ELSE 'other' END AS kind FROM lineitem")
def supplement_kinds(spark, sf):
    return tables.classify(tables.profiles(_deg_lines(spark, sf))).select("path", "kind")

def _deg_lines(spark, sf):
    line = F.concat(F.expr(PROBE), F.lit("\t"), (F.col("q") / 10).cast("string"), F.lit("\t0.0"), F.col("l_linenumber").cast("string"))
    head = F.expr("CASE l_orderkey % 3 WHEN 0 THEN 'Gene\tlog2 Fold Change\tp.value padj' WHEN 1 THEN 'Gene\tkegg pathway\tterm' ELSE 'Gene\ta\tb' END")
    return _laid_out(_lines(spark, sf).select("l_orderkey", "l_linenumber", line.alias("line")), [head])

@query("deg_table", A.sql(
    "SELECT l_orderkey AS path, CASE l_linenumber WHEN 1 THEN 'ALB' WHEN 2 THEN 'POU5F1' ELSE 'HNF4A' END AS gene_symbol, ROUND(q / 10, 6) AS log2fc, "
    "l_linenumber / CAST(100 AS DOUBLE) AS padj FROM ln WHERE l_linenumber IN (1, 2, 4) AND l_orderkey % 3 = 0", ONE_LINE))
def deg_table(spark, sf):
    lines = _deg_lines(spark, sf)
    found = tables.classify(tables.profiles(lines)).where("kind = 'deg_list'")
    return rounded(tables.deg_rows(tables.panel_rows(lines, found)).select("path", "gene_symbol", "log2fc", "padj"), "log2fc")

# -- wide files whose columns differ ----------------------------------------------------------------------------

@query("drifting_matrices", A.sql(
    "SELECT l_orderkey % 3 AS path, CAST(l_orderkey AS VARCHAR) AS key, CAST(l_linenumber AS VARCHAR) AS line_no, c AS \"column\", CASE c WHEN 'q' THEN q WHEN 'e' THEN e END AS value "
    "FROM ln, (VALUES ('q', 0), ('e', 0), ('q', 1), ('e', 1), ('note', 1), ('e', 2)) t(c, f) WHERE f = l_orderkey % 3", ONE_LINE))
def drifting_matrices(spark, sf):
    """Three files: columns in another order, one more, one fewer."""
    r = _least(table(spark, sf, "lineitem"))
    row = F.expr("CASE l_orderkey % 3 WHEN 0 THEN concat_ws('\t', l_orderkey, l_linenumber, q, e) "
                 "WHEN 1 THEN concat_ws('\t', e, l_orderkey, 'x', q, l_linenumber) ELSE concat_ws('\t', e, l_linenumber, l_orderkey, 'beyond') END")
    at = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    rows = r.select((F.col("l_orderkey") % 3).alias("path"), F.struct(F.lit(0).cast("bigint").alias("block"), at.cast("bigint").alias("at")).alias("pos"), row.alias("line"))
    head = F.expr("CASE path WHEN 0 THEN 'key\tline_no\tq\te' WHEN 1 THEN 'e\tkey\tnote\tq\tline_no' ELSE 'e\tline_no\tkey' END")
    first = F.struct(F.lit(0).cast("bigint").alias("block"), F.lit(-1).cast("bigint").alias("at"))
    heads = rows.select("path").distinct().select("path", first.alias("pos"), head.alias("line"))
    return tables.wide_cells(rows.unionByName(heads), ["key", "line_no"])

@query("merge_files",
       "WITH g AS (SELECT l_suppkey AS gse_id, CASE l_linenumber % 2 WHEN 0 THEN 'ALB' ELSE 'AFP' END AS gene_symbol, 's' || l_partkey AS sample, "
       "l_quantity AS value, l_orderkey * 10 + l_linenumber AS file_no, l_extendedprice FROM lineitem), "
       "m AS (SELECT gse_id, gene_symbol, sample, arg_max(value, file_no * 1000000 + value) AS value FROM (SELECT gse_id, gene_symbol, sample, file_no, MAX(value) AS value FROM g GROUP BY 1, 2, 3, 4) q GROUP BY 1, 2, 3) "
       "SELECT *, gse_id IN (SELECT gse_id FROM m GROUP BY gse_id, gene_symbol HAVING COUNT(*) > 310) AS wide FROM m")
def merge_files(spark, sf):
    rows = table(spark, sf, "lineitem").selectExpr(
        "l_suppkey AS gse_id", "CASE l_linenumber % 2 WHEN 0 THEN 'ALB' ELSE 'AFP' END AS gene_symbol", "'s' || l_partkey AS sample",
        "l_quantity AS value", "l_orderkey * 10 + l_linenumber AS file_no")
    rows = rows.groupBy("gse_id", "gene_symbol", "sample", "file_no").agg(F.max("value").alias("value"))
    return retrieval.merge_files(rows, wide_samples=310)

@query("measurements", A.sql(
    "SELECT ln.l_orderkey AS paper_id, CASE l_linenumber WHEN 1 THEN 'ALB' WHEN 2 THEN 'POU5F1' ELSE 'HNF4A' END AS gene_symbol, "
    "CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN 'oct4' ELSE 'ENSG00000101076.3' END AS gene_alias, " + CELL + " AS value, "
    "CASE WHEN sample = 'GSM1' THEN 'label' ELSE sample END AS condition_label, CASE WHEN sample = 'GSM1' THEN 5 END AS time_point_day, "
    "CAST(0.95 AS DOUBLE) AS confidence FROM ln, " + SAMPLES3 + " WHERE l_linenumber IN (1, 2, 4) AND k < 2", ONE_LINE))
def measurements(spark, sf):
    series = matrix.tables(matrix_lines(spark, sf))
    cells = matrix.gene_cells(series).select(
        F.col("path").alias("paper_id"), F.col("path").alias("protocol_id"), "gene", "sample", "value", F.lit("GSE1 series matrix").alias("source_detail"))
    lookup = series.frames.select(F.col("path").alias("protocol_id"), F.lit("GSM1").alias("sample_key"), F.lit("label").alias("condition_label"),
                                  F.lit(5).alias("time_point_day"))
    return retrieval.measurements(cells, "series_matrix", lookup=lookup).select(
        "paper_id", "gene_symbol", "gene_alias", "value", "condition_label", "time_point_day", "confidence")

@query("usable_accessions", "SELECT o_custkey AS paper_id, o_orderkey AS id FROM orders o WHERE o_orderstatus = 'F' OR NOT EXISTS (SELECT 1 FROM orders x "
       "WHERE x.o_custkey = o.o_custkey AND x.o_orderstatus = 'F')")
def usable_accessions(spark, sf):
    a = table(spark, sf, "orders").selectExpr(
        "o_custkey AS paper_id", "o_orderkey AS id", "CASE o_orderstatus WHEN 'F' THEN 'own_data' ELSE 'referenced' END AS context")
    return retrieval.usable_accessions(a).select("paper_id", "id")

@query("waterfall", A.sql(
    "SELECT id, paper_id FROM (SELECT *, MIN(tier) OVER (PARTITION BY paper_id) AS best FROM (SELECT id, paper_id, CASE WHEN id % 7 = 0 AND paper_id % 2 = 0 THEN 0 "
    "WHEN id % 2 = 0 AND paper_id % 3 <> 1 THEN 1 ELSE 2 END AS tier FROM ev) q) q WHERE tier = best", A.EV))
def waterfall(spark, sf):
    v = A.values(spark, sf).withColumn("t", F.expr(
        "CASE WHEN id % 7 = 0 AND paper_id % 2 = 0 THEN 0 WHEN id % 2 = 0 AND paper_id % 3 <> 1 THEN 1 ELSE 2 END"))

    def tier(i):
        return lambda keys: v.where(F.col("t") == i).join(keys, "paper_id", "left_semi")
    return acquire.staged(v.select("paper_id"), ["paper_id"], [tier(i) for i in range(3)]).select("id", "paper_id")

# -- records ---------------------------------------------------------------------------------------------------

def _soft(spark, sf):
    """A series record per order, with a sample record per line."""
    one = F.concat(F.lit("^SAMPLE = GSM"), F.col("l_linenumber").cast("string"), F.lit("\n!Sample_title = Day "), F.col("l_linenumber").cast("string"),
                   F.lit("\n!Sample_characteristics_ch1 = cell: x:y\n!Sample_characteristics_ch1 = q: "), F.col("q").cast("int").cast("string"),
                   F.lit("\n!Sample_characteristics_ch1 = cell: z\n!Sample_relation = SRA: https://x/SRX"), F.col("l_orderkey").cast("string"), F.lit("\n"))
    g = _lines(spark, sf).groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", one.alias("t")))).alias("r"))
    head = F.concat(F.lit("^SERIES = GSE"), F.col("l_orderkey"), F.lit("\n!Series_geo_accession = GSE"), F.col("l_orderkey"),
                    F.lit("\n!Series_title = a=b\n!Series_summary = one\n!Series_summary = two\n!Series_organism = Homo sapiens\n!Series_organism = Mus\n"
                          "!Series_relation = BioProject: https://x/PRJNA7\n!Series_supplementary_file = ftp://h/suppl/GSE"), F.col("l_orderkey"),
                    F.lit("_tpm_matrix.txt.gz\n!Series_pubmed_id = 11\n!Series_pubmed_id = 12\n"),
                    F.array_join(F.transform("r", lambda x: F.concat(F.lit("!Series_sample_id = GSM"), x["l_linenumber"].cast("string"))), "\n"), F.lit("\n"))
    return g.select(F.concat(F.lit("GSE"), F.col("l_orderkey")).alias("accession"),
                    F.concat(head, F.array_join(F.transform("r", lambda x: x["t"]), "")).alias("soft"))

@query("soft_series", A.sql(
    "SELECT 'GSE' || l_orderkey AS accession, 'a=b' AS title, 'one two' AS summary, 'Homo sapiens' AS organism, CAST(COUNT(*) AS INTEGER) AS sample_count, "
    "'11,12' AS pmids FROM ln GROUP BY l_orderkey", ONE_LINE))
def soft_series(spark, sf):
    s = soft.series(_soft(spark, sf))
    return s.select("accession", "title", "summary", "organism", "sample_count", F.array_join("linked_pmids", ",").alias("pmids"))

@query("soft_records", A.sql(
    "SELECT 'GSE' || l_orderkey AS accession, 'GSM' || l_linenumber AS gsm_id, 'Day ' || l_linenumber AS sample_title, 'z' AS cell, CAST(CAST(q AS INTEGER) AS VARCHAR) AS q, "
    "'SRX' || l_orderkey AS sra_accession FROM ln", ONE_LINE))
def soft_records(spark, sf):
    s = soft.samples(_soft(spark, sf))
    return s.select("accession", "gsm_id", "sample_title", F.col("characteristics")["cell"].alias("cell"),
                    F.col("characteristics")["q"].alias("q"), "sra_accession")

@query("soft_project", "SELECT DISTINCT 'GSE' || l_orderkey AS accession, 'PRJNA7' AS project FROM lineitem")
def soft_project(spark, sf):
    return soft.linked_project(_soft(spark, sf))

@query("series_files",
       "SELECT DISTINCT 'GSE' || l_orderkey AS accession, 'GSE' || l_orderkey || '_tpm_matrix.txt.gz' AS filename, "
       "'text_table' AS file_type, TRUE AS has_count_matrix FROM lineitem")
def series_files(spark, sf):
    return crossref.series_files(_soft(spark, sf)).drop("url")

RUNS = [("'PRJ' || l_suppkey", "accession"), ("'s' || l_partkey", "sample_alias"),
        ("CASE l_linenumber % 3 WHEN 0 THEN 'HiSeq' WHEN 1 THEN 'NovaSeq' ELSE '' END", "instrument_model"),
        ("CASE WHEN l_suppkey % 3 = 0 THEN 'RNA-Seq' WHEN l_suppkey % 3 = 1 THEN 'ChIP-Seq' ELSE 'WGS' END", "library_strategy"),
        ("CASE WHEN l_suppkey % 2 = 0 THEN 'Homo sapiens' ELSE 'Mus musculus' END", "scientific_name"),
        ("CASE WHEN l_linenumber = 7 THEN 'n/a' ELSE CAST(CAST(l_quantity AS INTEGER) AS STRING) END", "read_count")]

@query("runs_by_accession",
       "SELECT accession, COUNT(DISTINCT sample_alias) AS sample_count, CASE WHEN MAX(instrument_model) = 'NovaSeq' AND BOOL_OR(instrument_model = 'HiSeq') THEN 'HiSeq, NovaSeq' "
       "ELSE NULLIF(MAX(instrument_model), '') END AS platform, MAX(scientific_name) AS organism, CASE MAX(library_strategy) WHEN 'RNA-Seq' THEN 'bulk_rnaseq' WHEN 'ChIP-Seq' THEN 'chip_seq' "
       "ELSE 'unknown' END AS data_type, CAST(SUM(COALESCE(TRY_CAST(read_count AS BIGINT), 0)) AS BIGINT) AS total_reads FROM (SELECT "
       + ", ".join(f"{e} AS {a}" for e, a in RUNS) + " FROM lineitem) q GROUP BY accession")
def runs_by_accession(spark, sf):
    runs = table(spark, sf, "lineitem").selectExpr(*[f"{e} AS {a}" for e, a in RUNS])
    return repositories.aggregate_runs(runs)

@query("document_summaries", "SELECT CAST(c_custkey AS VARCHAR) AS pmc_id, CAST(c_custkey + 5 AS VARCHAR) AS pmid, c_name AS title, 'J ' || c_mktsegment AS journal FROM customer")
def document_summaries(spark, sf):
    c = table(spark, sf, "customer").selectExpr(
        "'<DocumentSummary><Id>' || c_custkey || '</Id><Title>' || c_name || '</Title><Source>J ' || c_mktsegment || '</Source><ArticleIds><ArticleId>"
        "<IdType>pmid</IdType><Value>' || (c_custkey + 5) || '</Value></ArticleId></ArticleIds></DocumentSummary>' AS answer")
    return repositories.document_summaries(c).select("pmc_id", "pmid", "title", "journal")

# -- exports ---------------------------------------------------------------------------------------------------

@query("export_protocols", A.sql(
    "SELECT pr.id AS protocol_id, pa.pmc_id, pa.doi, pa.title, pr.protocol_arm AS arm, CAST(s.n AS INTEGER) AS num_stages, pr.extraction_confidence AS confidence, "
    "pr.pass_number AS pass, CASE WHEN pr.is_optimized THEN 'Yes' ELSE 'No' END AS optimized, 'ALB: 5; AFP' AS endpoint_markers, 'CYP: 7 pmol; stain' AS functional_assays "
    "FROM pr JOIN pa ON pa.id = pr.paper_id JOIN (SELECT protocol_id, COUNT(*) AS n FROM st GROUP BY 1) s ON s.protocol_id = pr.id", A.PR, A.PA, A.ST))
def export_protocols(spark, sf):
    p = A.staged_protocols(spark, sf).withColumn("endpoint_assessment", F.expr(
        "named_struct('markers', array(named_struct('marker_name', 'ALB', 'value', '5'), named_struct('marker_name', 'AFP', 'value', CAST(NULL AS STRING))), "
        "'functional_assays', array(named_struct('assay_name', 'CYP', 'value', '7', 'unit', 'pmol'), named_struct('assay_name', 'stain', 'value', CAST(NULL AS STRING), "
        "'unit', CAST(NULL AS STRING))))")).withColumn("cell_source", F.expr(
            "named_struct('type', 'iPSC', 'line_name', 'L1', 'organism', 'human')")).withColumn(
        "culture_system", F.expr("named_struct('format', '2D', 'substrate', 'x', 'oxygen_condition', 'y')"))
    s = export.protocols_sheet(p, A.papers(spark, sf))
    return s.drop("cell_type", "cell_line", "organism", "culture_format", "substrate", "o2")

@query("export_stages", A.sql(
    "SELECT protocol_id, pa.pmc_id, CAST(ROW_NUMBER() OVER (PARTITION BY protocol_id ORDER BY l_linenumber) AS INTEGER) AS stage_no, stage_name, "
    "CAST(duration_days AS VARCHAR) AS duration_days, 'RPMI' AS base_medium, 'Activin A (' || (duration_days * 10) || ' ng/ml)' AS growth_factors, "
    "CASE WHEN l_linenumber % 2 = 0 THEN 'CHIR99021' ELSE '' END AS small_molecules, 'SOX17: ' || duration_days || '; FOXA2' AS stage_markers "
    "FROM st JOIN pr ON pr.id = st.protocol_id JOIN pa ON pa.id = pr.paper_id", A.ST, A.PR, A.PA))
def export_stages(spark, sf):
    s = export.stages_sheet(A.staged_protocols(spark, sf, reagents=True), A.papers(spark, sf))
    return s.drop("supplements", "seeding_density", "medium_change_frequency")

DAYM = ("dm AS (SELECT protocol_id, time_point_day, gene, ROUND(AVG(value), 6) AS value, MIN(unit) AS unit, MIN(condition_label) AS condition_label FROM ev WHERE gene <> 'GAPDH' "
        "AND protocol_id IS NOT NULL AND time_point_day IS NOT NULL GROUP BY 1, 2, 3)")
ACTIVE = ("act AS (SELECT dm.*, (SELECT MIN(stage_number) FROM rg WHERE rg.protocol_id = dm.protocol_id AND rg.protocol_id IN (SELECT id FROM pr) AND dm.time_point_day BETWEEN start_day AND end_day) "
          "AS stage_no FROM dm)")

@query("export_stage_expression", A.sql(
    "SELECT act.protocol_id, pa.pmc_id, time_point_day, gene AS gene_symbol, value, unit, condition_label, COALESCE(rg.stage_name, '') AS stage_name, stage_no "
    "FROM act LEFT JOIN rg ON rg.protocol_id = act.protocol_id AND rg.stage_number = stage_no LEFT JOIN (SELECT * FROM pr WHERE id IN (SELECT protocol_id FROM st)) pr ON pr.id = act.protocol_id LEFT JOIN pa ON pa.id = pr.paper_id",
    A.EV, A.PR, A.PA, A.ST, A.RG, DAYM, ACTIVE))
def export_stage_expression(spark, sf):
    return rounded(export.stage_expression_rows(A.values(spark, sf), A.staged_protocols(spark, sf), A.papers(spark, sf)), "value")

@query("export_stage_expression_wide", A.sql(
    "SELECT act.protocol_id, pa.pmc_id, time_point_day AS day, COALESCE(MAX(rg.stage_name), '') AS stage_name, COALESCE(MAX(CASE WHEN rg.stage_name IS NOT NULL THEN 'Activin A (' || (rg.duration_days * 10) || ' ng/ml)' END), '') "
    "AS growth_factors, " + ", ".join(f"MAX(CASE WHEN gene = '{g}' THEN value END) AS \"{g}\"" for g in SHOWN)
    + " FROM act LEFT JOIN rg ON rg.protocol_id = act.protocol_id AND rg.stage_number = stage_no JOIN pr ON pr.id = act.protocol_id JOIN pa ON pa.id = pr.paper_id "
      "WHERE act.protocol_id IN (SELECT protocol_id FROM st) GROUP BY 1, 2, 3",
    A.EV, A.PR, A.PA, A.ST, A.RG, DAYM, ACTIVE))
def export_stage_expression_wide(spark, sf):
    p = A.staged_protocols(spark, sf, reagents=True).withColumn("cell_source", F.expr("named_struct('type', 'iPSC', 'line_name', 'L1')")).withColumn(
        "culture_system", F.expr("named_struct('format', '2D')"))
    s = export.stage_expression_sheet(A.values(spark, sf), p, A.papers(spark, sf), SHOWN)
    return rounded(s.select("protocol_id", "pmc_id", "day", "stage_name", "growth_factors", *SHOWN), *SHOWN)

@query("export_all_expression", A.sql(
    "SELECT pa.pmc_id, pa.doi, pr.protocol_arm, gene_symbol, value, unit, condition_label, time_point_day, comparison, padj, source_type, source_detail, confidence "
    "FROM ev JOIN pa ON pa.id = ev.paper_id LEFT JOIN pr ON pr.id = ev.protocol_id", A.EV, A.PA, A.PR))
def export_all_expression(spark, sf):
    return export.all_expression_sheet(A.values(spark, sf), A.papers(spark, sf), A.protocols(spark, sf))

@query("export_rnaseq", A.sql(
    "SELECT pa.pmc_id, CASE WHEN id % 2 = 0 THEN 'Yes' ELSE 'No' END AS has_rnaseq, NULLIF(CAST(CASE WHEN id % 3 = 0 THEN 0 ELSE id % 50 + 1 END AS INTEGER), 0) AS deg_up, "
    "CAST(NULL AS INTEGER) AS deg_down, 'GSE' || id || '; SRP1' AS accessions FROM pa", A.PA))
def export_rnaseq(spark, sf):
    r = table(spark, sf, "customer").selectExpr(
        "c_custkey AS paper_id", "c_custkey % 2 = 0 AS has_rnaseq", *[f"CAST(NULL AS STRING) AS {c}" for c in (
            "technology", "library_prep", "read_type", "genome_build", "alignment_tool", "quantification_tool", "normalization")],
        "named_struct('comparisons', CASE WHEN c_custkey % 3 <> 0 THEN array(named_struct('n_up', CAST(c_custkey % 50 AS INT), 'n_down', 0), named_struct('n_up', 1, 'n_down', "
        "CAST(NULL AS INT))) END) AS deg_summary",
        "array(named_struct('accession', 'GSE' || c_custkey), named_struct('accession', ''), named_struct('accession', 'SRP1')) AS accessions",
        "named_struct('repository', 'GEO') AS data_availability")
    return export.rnaseq_sheet(r, A.papers(spark, sf)).select("pmc_id", "has_rnaseq", "deg_up", "deg_down", "accessions")

RECORDS = ("rec AS (SELECT o_custkey AS paper_id, 'GSE' || o_orderkey AS accession, CASE WHEN o_orderkey % 3 = 0 THEN 'SRA' ELSE 'GEO' END AS repository, "
           "CASE WHEN o_orderkey % 2 = 0 THEN 'set' END AS organism FROM orders)")

@query("backfill_repository", A.sql(
    "SELECT accession, CASE WHEN repository = 'GEO' THEN COALESCE(organism, 'Homo sapiens') ELSE organism END AS organism, "
    "CASE WHEN repository = 'GEO' THEN l.n END AS n_samples FROM rec LEFT JOIN (SELECT l_orderkey, CAST(COUNT(DISTINCT l_linenumber) AS INTEGER) AS n FROM lineitem GROUP BY 1) l "
    "ON rec.accession = 'GSE' || l.l_orderkey", RECORDS))
def backfill_repository(spark, sf):
    o = table(spark, sf, "orders")
    rec = o.selectExpr("o_custkey AS paper_id", "'GSE' || o_orderkey AS accession", "CASE WHEN o_orderkey % 3 = 0 THEN 'SRA' ELSE 'GEO' END AS repository",
                       "CASE WHEN o_orderkey % 2 = 0 THEN 'set' END AS organism")
    acc = o.selectExpr("o_orderkey AS id", "o_custkey AS paper_id", "'GSE' || o_orderkey AS gse_id", "'Homo sapiens' AS organism")
    s = _lines(spark, sf).selectExpr("l_orderkey AS geo_accession_id", "'GSM' || l_linenumber AS gsm_id", "'t' AS sample_title", "'s' AS source_name")
    counts = backfill.repository_samples(rec, acc, s).groupBy("accession").agg(F.count(F.lit(1)).cast("int").alias("n_samples"))
    return backfill.repository_records(rec, acc).join(counts, "accession", "left").select("accession", "organism", "n_samples")


@query("stage_summary", A.sql(
    "SELECT pr.id, string_agg(stage_name || ' (' || duration_days || 'd): Activin A' || CASE WHEN l_linenumber % 2 = 0 THEN ', CHIR99021' ELSE '' END, ' / ' ORDER BY l_linenumber) "
    "AS summary FROM pr JOIN st ON st.protocol_id = pr.id GROUP BY 1", A.PR, A.ST))
def stage_summary_lines(spark, sf):
    p = A.staged_protocols(spark, sf, reagents=True)
    return p.select("id", F.array_join(stage_summary(F.col("stages")), " / ").alias("summary"))

# -- manifest --------------------------------------------------------------------------------------------------

DETAILS = ("CASE o_orderkey % 4 WHEN 0 THEN 'see 10.5/a' || (o_custkey % 9) || '; gone' WHEN 1 THEN 'see 10.5555/b' || (o_custkey % 20) || '). done' "
           "WHEN 2 THEN 'Si-Tayeb et al. [' || (2000 + o_custkey % 5) || '] closed' ELSE '' END")
REASON = "CASE WHEN o_orderkey % 7 = 0 THEN 'not_reported' ELSE 'behind_paywall_reference' END"
WANTED = ("wt AS (SELECT o_orderkey AS protocol_id, 'PMC' || o_custkey AS pmc_id, " + DETAILS + " AS d, o_orderkey % 7 <> 0 AS pay, "
          "CASE WHEN o_orderkey % 5 = 0 THEN '10.1/base' || (o_custkey % 3) END AS base, o_orderkey % 4 AS m, o_custkey FROM orders), "
          "wr AS (SELECT protocol_id, pmc_id, '10.5555/b' || (o_custkey % 20) AS doi, '10.5555/b' || (o_custkey % 20) AS key, d AS description FROM wt WHERE pay AND m = 1 UNION ALL "
          "SELECT protocol_id, pmc_id, base, base, CASE WHEN pay THEN d ELSE '' END FROM wt WHERE base IS NOT NULL UNION ALL "
          "SELECT protocol_id, pmc_id, NULL, 'no_doi__' || CASE m WHEN 2 THEN 'tayeb_et_al_' || (2000 + o_custkey % 5) WHEN 3 THEN 'unknown_ref' ELSE "
          "'see_10_5_a' || (o_custkey % 9) || '_gone' END || '_' || left(md5(d), 12), d FROM wt WHERE pay AND base IS NULL AND m <> 1)")

def _wanted(spark, sf):
    w = table(spark, sf, "orders").selectExpr(
        "o_orderkey AS protocol_id", "'PMC' || o_custkey AS pmc_id", "CASE WHEN o_orderkey % 5 = 0 THEN '10.1/base' || (o_custkey % 3) END AS base_protocol_doi",
        f"array(named_struct('field', 'f', 'reason', {REASON}, 'details', {DETAILS})) AS incomplete_flags", "CAST(NULL AS STRING) AS xml_path")
    return manual_fetch.wanted_references(w)

@query("wanted_references", A.sql("SELECT key, doi, description, protocol_id, pmc_id FROM wr", WANTED))
def wanted_references(spark, sf):
    return _wanted(spark, sf)

@query("manifest", A.sql(
    "SELECT 'ref_' || lpad(CAST(ROW_NUMBER() OVER (ORDER BY key) AS VARCHAR), 3, '0') AS id, key, MAX(doi) AS doi, COUNT(DISTINCT protocol_id) AS n_protocols, "
    "COUNT(DISTINCT pmc_id) AS n_papers, CASE WHEN MAX(doi) IS NOT NULL THEN replace(key, '/', '__') ELSE replace(key, 'no_doi__', '') END || '.pdf' AS suggested_filename, "
    "COALESCE(arg_min(description, protocol_id) FILTER (WHERE description <> ''), '') AS description FROM wr GROUP BY key", WANTED))
def manifest(spark, sf):
    return manual_fetch.manifest(_wanted(spark, sf)).drop("status")

# -- model answers ---------------------------------------------------------------------------------------------

REPLY = ("CASE conv_id % 4 WHEN 0 THEN '{\"category\": \"review\", \"confidence\": 0.5}' WHEN 1 THEN 'Sure:' || chr(10) || '```json' || chr(10) || '{\"category\": \"bogus\"}' || chr(10) || '```' "
         "WHEN 2 THEN 'Answer {\"category\": {\"a\": \"x}\"}} end }' ELSE 'no json' END")

@query("salvage_json",
       "SELECT conv_id, turn, CASE conv_id % 4 WHEN 0 THEN '{\"category\": \"review\", \"confidence\": 0.5}' WHEN 1 THEN '{\"category\": \"bogus\"}' END AS found FROM conversations")
def salvage_json(spark, sf):
    c = table(spark, sf, "conversations").selectExpr("conv_id", "turn", f"{REPLY} AS reply")
    return c.select("conv_id", "turn", T.salvage_json(F.col("reply")).alias("found"))

@query("validate_triage",
       "SELECT conv_id, turn, CASE conv_id % 3 WHEN 0 THEN 'review' WHEN 1 THEN 'bogus' END AS category, CASE conv_id % 3 WHEN 0 THEN NULL WHEN 1 THEN 'invalid_category: bogus' ELSE "
       "'parse_failed' END AS error FROM conversations")
def validate_triage(spark, sf):
    c = table(spark, sf, "conversations").selectExpr(
        "conv_id", "turn", "CASE conv_id % 3 WHEN 0 THEN '{\"category\": \"review\"}' WHEN 1 THEN '{\"category\": \"bogus\"}' ELSE 'oops' END AS reply",
        "CAST(NULL AS STRING) AS call_error")
    return extraction.validate_triage(c).select("conv_id", "turn", "category", "error")

@query("flag_validation",
       "SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'rejected' WHEN event_id % 3 = 2 THEN 'rejected' ELSE 'flagged' END AS status, CASE WHEN event_id % 5 = 0 THEN 'Missing ''field'' parameter' "
       "WHEN event_id % 3 = 2 THEN 'Invalid reason ''' || event_type || '''' END AS error FROM events")
def flag_validation(spark, sf):
    e = table(spark, sf, "events").selectExpr(
        "event_id", "CASE WHEN event_id % 5 = 0 THEN '  ' ELSE event_type END AS field",
        "CASE event_id % 3 WHEN 0 THEN 'not_reported' WHEN 1 THEN ' qualitative_only ' ELSE event_type END AS reason", "CAST(NULL AS STRING) AS details")
    return extraction.flags_of_calls(e).select("event_id", "status", "error")

@query("tool_call_cap",
       "SELECT conv_id, turn, CAST(rn AS INTEGER) AS call_no FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM conversations) q WHERE rn <= 5")
def tool_call_cap(spark, sf):
    return extraction.cap_tool_calls(table(spark, sf, "conversations").select("conv_id", "turn"), ["conv_id"], "turn")

_kinds = ", ".join(f"'{c}'" for c in dims.TRIAGE_CATEGORIES)

@query("stub_triage",
       f"SELECT 'PMC' || doc_id AS pmc_id, CASE WHEN doc_id % 9 = 0 THEN NULL ELSE ([{_kinds}])[1 + (length(text) + length('Title: T' || doc_id) + 12) % 6] END AS category, "
       "CASE WHEN doc_id % 9 = 0 THEN 'no_abstract' END AS error FROM documents")
def stub_triage(spark, sf):
    d = table(spark, sf, "documents").selectExpr(
        "'PMC' || doc_id AS pmc_id", "CAST(NULL AS STRING) AS doi", "CAST(NULL AS STRING) AS pmid", "'T' || doc_id AS title", "CAST(NULL AS STRING) AS article_type",
        "CASE WHEN doc_id % 9 = 0 THEN ' ' ELSE text END AS abstract")
    return extraction.triage(d, "Classify.").select("pmc_id", "category", "error")

MERGE_OLD = "array(named_struct('marker_name', 'ALB', 'value', '1'))"

@query("merge_supplement", A.sql(
    "SELECT id, CASE WHEN id % 3 = 0 THEN 'ALB' ELSE 'ALB,AFP,AFP' END AS markers, CASE WHEN id % 3 = 0 THEN 2 ELSE 3 END AS pass_number, "
    "CASE WHEN id % 3 = 0 THEN 'n' ELSE 'n | Pass 3: more' END AS extraction_notes, CASE WHEN id % 3 = 0 THEN '' ELSE 'X1' END AS stage_markers FROM pr", A.PR))
def merge_supplement(spark, sf):
    marker = "array<struct<marker_name:string,value:string>>"
    assay = "array<struct<assay_name:string,value:string,unit:string>>"
    p = A.protocols(spark, sf).selectExpr(
        "id", "2 AS pass_number", "'n' AS extraction_notes", f"named_struct('markers', {MERGE_OLD}, 'functional_assays', CAST(NULL AS {assay})) AS endpoint_assessment",
        f"array(named_struct('stage_name', 'S', 'stage_markers', CAST(NULL AS {marker})), named_struct('stage_name', 'R', 'stage_markers', CAST(NULL AS {marker}))) AS stages")
    u = A.protocols(spark, sf).selectExpr(
        "id", "id % 3 = 0 AS no_additional_data", "array(named_struct('marker_name', 'ALB', 'value', '9'), named_struct('marker_name', 'AFP', 'value', '2'), "
        "named_struct('marker_name', 'AFP', 'value', '3')) AS markers", f"CAST(NULL AS {assay}) AS functional_assays",
        "array(named_struct('stage_name', 'S', 'additional_markers', array(named_struct('marker_name', 'X1', 'value', '0')))) AS stage_updates", "'more' AS notes")
    m = extraction.merge_supplement(p, u)
    return m.select(
        "id", F.array_join(F.transform("endpoint_assessment.markers", lambda x: x["marker_name"]), ",").alias("markers"), "pass_number", "extraction_notes",
        F.array_join(F.transform(F.flatten(F.transform("stages", lambda s: F.coalesce(s["stage_markers"], F.array()))), lambda x: x["marker_name"]), ",").alias("stage_markers"))
