"""The given tables read as papers, protocols, stages, samples and measurements.

Each adapter is a list of SQL expressions that Spark and the checking engine both understand, so a query and
its check start from the same relation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPARK_DAY = "datediff(CAST(ts AS DATE), DATE '2024-01-01')"
DUCK_DAY = "CAST(CAST(ts AS DATE) - DATE '2024-01-01' AS INTEGER)"
NULL_S = "CAST(NULL AS STRING)"

# -- measurements (events) -------------------------------------------------------------------------------------

RAW_GENE = """CASE event_type
 WHEN 'signup' THEN CASE WHEN event_id % 2 = 0 THEN 'OCT4' ELSE ' pou5f1' END
 WHEN 'click' THEN CASE WHEN event_id % 3 = 0 THEN 'ENSG00000164736.14' ELSE 'SOX17' END
 WHEN 'view' THEN CASE WHEN event_id % 4 = 0 THEN '3172' ELSE 'HNF4A' END
 WHEN 'purchase' THEN CASE WHEN event_id % 5 = 0 THEN 'ALB_chr4' WHEN event_id % 5 = 1 THEN 'albumin' ELSE 'ALB' END
 ELSE CASE WHEN event_id % 7 = 0 THEN 'GAPDH' ELSE 'VIM' END END"""
GENE = """CASE event_type WHEN 'signup' THEN 'POU5F1' WHEN 'click' THEN 'SOX17' WHEN 'view' THEN 'HNF4A'
 WHEN 'purchase' THEN 'ALB' ELSE CASE WHEN event_id % 7 = 0 THEN 'GAPDH' ELSE 'VIM' END END"""

VALUES = [
    ("event_id", "id"),
    ("CASE WHEN event_id % 29 = 0 THEN NULL ELSE user_id END", "protocol_id"),
    ("user_id % 40", "paper_id"),
    (RAW_GENE, "gene_symbol"),
    (NULL_S, "gene_alias"),
    ("CASE WHEN event_id % 17 = 0 THEN CAST(0 AS DOUBLE) WHEN event_id % 23 = 0 THEN NULL ELSE value END", "value"),
    ("'tpm'", "unit"),
    ("'D' || {day} || '_rep' || (event_id % 3)", "condition_label"),
    ("CASE WHEN event_id % 31 = 0 THEN NULL ELSE {day} END", "time_point_day"),
    (NULL_S, "comparison"),
    ("CAST(NULL AS DOUBLE)", "padj"),
    ("CASE WHEN event_id % 2 = 0 THEN 'geo_matrix' ELSE 'supplement_table' END", "source_type"),
    ("CASE WHEN event_id % 2 = 0 THEN 'GSE' || (10000 + user_id) || ' series matrix' "
     "WHEN event_id % 4 = 1 THEN 'Supplement DEG: DEG_D' || {day} || '_vs_D0.csv' "
     "ELSE 'Supplement expression: table.csv' END", "source_detail"),
    ("CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) / CAST(100 AS DOUBLE)", "confidence"),
]

# -- papers (customer) -----------------------------------------------------------------------------------------

PAPERS = [
    ("c_custkey", "id"),
    ("'PMC' || (1000000 + c_custkey)", "pmc_id"),
    ("CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE '10.1000/x' || c_custkey END", "doi"),
    ("CAST(30000000 + c_custkey AS STRING)", "pmid"),
    ("c_name", "title"),
    ("CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'primary_protocol' WHEN 'BUILDING' THEN 'disease_model' "
     "WHEN 'FURNITURE' THEN 'methods_tool' WHEN 'HOUSEHOLD' THEN 'review' ELSE 'tangential' END", "triage_category"),
    ("CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE 'PMC10/PMC' || (1000000 + c_custkey) || '.xml' END", "xml_path"),
    ("CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'text/' || c_custkey || '.md' END", "parsed_text_path"),
    ("CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'none' ELSE 'supp/' || c_custkey END", "supplement_dir"),
    ("CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'supp/' || c_custkey || '.md' END", "supplement_text_path"),
    ("CASE c_custkey % 4 WHEN 0 THEN 'pending' WHEN 2 THEN 'failed' ELSE 'completed' END", "extraction_status"),
    ("CAST(c_custkey % 10 AS INTEGER)", "processing_priority"),
    ("CASE c_custkey % 6 WHEN 0 THEN 'linked' WHEN 1 THEN 'checked_none' ELSE NULL END", "geo_status"),
    ("CASE c_custkey % 9 WHEN 0 THEN 'has_rnaseq' WHEN 1 THEN 'no_rnaseq' ELSE NULL END", "rnaseq_status"),
]

# -- protocols (orders) and their stages (lineitem) ------------------------------------------------------------

PROTOCOLS = [
    ("o_orderkey", "id"), ("o_custkey", "paper_id"), ("o_orderpriority", "protocol_arm"),
    ("o_orderkey % 2 = 0", "is_optimized"),
    ("CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE (o_orderkey % 101) / CAST(100 AS DOUBLE) END",
     "extraction_confidence"),
    ("CASE WHEN o_orderkey % 5 = 0 THEN 3 ELSE 2 END", "pass_number"),
    ("CASE WHEN o_orderkey % 3 = 0 THEN '10.1000/x' || (o_custkey % 50) ELSE NULL END", "base_protocol_doi"),
    ("o_orderkey % 10 = 0", "needs_manual_fetch"),
]

STAGE_NAME = """CASE l_linenumber WHEN 1 THEN 'Definitive Endoderm' WHEN 2 THEN 'Hepatic Specification'
 WHEN 3 THEN 'Hepatoblast Expansion' WHEN 4 THEN 'Maturation I' ELSE 'Phase ' || l_linenumber END"""

# -- samples (events) ------------------------------------------------------------------------------------------

SAMPLES = [
    ("event_id", "id"), ("user_id", "geo_accession_id"), ("'GSM' || (100000 + event_id)", "gsm_id"),
    ("CASE event_id % 5 WHEN 0 THEN 'Day ' || {day} || ' ' || event_type WHEN 1 THEN 'WT D' || {day} || ' rep' "
     "WHEN 2 THEN 'hepatoblast ' || event_type WHEN 3 THEN 'control ' || event_type ELSE {day} || ' days HLC' END",
     "sample_title"),
    ("CASE WHEN event_id % 3 = 0 THEN 'iPSC' ELSE 'cells' END", "source_name"),
]


def _read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def _project(df: DataFrame, columns) -> DataFrame:
    return df.selectExpr(*[f"{e.format(day=SPARK_DAY)} AS {a}" for e, a in columns])


def _cte(table: str, columns) -> str:
    return "SELECT " + ", ".join(f"{e.format(day=DUCK_DAY)} AS {a}" for e, a in columns) + f" FROM {table}"


def values(spark, sf):
    return _project(_read(spark, sf, "events"), VALUES)


def papers(spark, sf):
    return _project(_read(spark, sf, "customer"), PAPERS)


def samples(spark, sf):
    return _project(_read(spark, sf, "events"), SAMPLES)


def protocols(spark, sf):
    return _project(_read(spark, sf, "orders"), PROTOCOLS)


def stage_rows(spark, sf):
    """(protocol_id, pos, duration_days): line numbers repeat within an order, the shortest one stands."""
    return (_read(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("protocol_id"), "l_linenumber")
            .agg(F.min(F.expr("CAST(l_quantity AS INT) % 7")).alias("duration_days"))
            .selectExpr("protocol_id", "l_linenumber", f"{STAGE_NAME} AS stage_name", "duration_days"))


def staged_protocols(spark, sf, reagents: bool = False):
    """Protocols with their ordered stage array; an order has a handful of line numbers."""
    rows = stage_rows(spark, sf)
    fields = ["stage_name", F.col("duration_days").cast("string").alias("duration_days")]
    if reagents:
        fields += [
            F.lit("RPMI").alias("base_medium"),
            F.expr("array(named_struct('name', 'Activin A', 'concentration', CAST(duration_days * 10 AS STRING), "
                   "'concentration_unit', 'ng/ml'))").alias("growth_factors"),
            F.expr("CASE WHEN l_linenumber % 2 = 0 THEN array(named_struct('name', 'CHIR99021', 'concentration', "
                   "CAST(NULL AS STRING), 'concentration_unit', CAST(NULL AS STRING))) END").alias("small_molecules"),
            F.expr("CAST(NULL AS array<struct<name:string,concentration:string,concentration_unit:string>>)")
            .alias("supplements"),
            F.lit(None).cast("string").alias("seeding_density"),
            F.lit(None).cast("string").alias("medium_change_frequency"),
            F.expr("array(named_struct('marker_name', 'SOX17', 'value', CAST(duration_days AS STRING)), "
                   "named_struct('marker_name', 'FOXA2', 'value', CAST(NULL AS STRING)))").alias("stage_markers"),
        ]
    stages = (rows.groupBy("protocol_id")
              .agg(F.array_sort(F.collect_list(F.struct("l_linenumber", *fields))).alias("stages")))
    return protocols(spark, sf).join(stages.withColumnRenamed("protocol_id", "id"), "id")


EV = ("ev AS (SELECT v.*, g.gene FROM (" + _cte("events", VALUES) + ") v JOIN (SELECT event_id, "
      + GENE + " AS gene FROM events) g ON v.id = g.event_id)")
PA = "pa AS (" + _cte("customer", PAPERS) + ")"
PR = "pr AS (" + _cte("orders", PROTOCOLS) + ")"
SA = "sa AS (" + _cte("events", SAMPLES) + ")"
ST = ("st AS (SELECT protocol_id, l_linenumber, " + STAGE_NAME + " AS stage_name, duration_days FROM (SELECT "
      "l_orderkey AS protocol_id, l_linenumber, CAST(MIN(CAST(l_quantity AS INTEGER) % 7) AS INTEGER) AS duration_days "
      "FROM lineitem GROUP BY 1, 2) q)")
RG = ("rg AS (SELECT protocol_id, CAST(ROW_NUMBER() OVER w AS INTEGER) AS stage_number, stage_name, "
      "CAST(COALESCE(SUM(duration_days) OVER (PARTITION BY protocol_id ORDER BY l_linenumber "
      "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS start_day, "
      "CAST(SUM(duration_days) OVER w AS INTEGER) AS end_day, duration_days, "
      "COUNT(*) OVER (PARTITION BY protocol_id) AS n_stages "
      "FROM st WINDOW w AS (PARTITION BY protocol_id ORDER BY l_linenumber))")


def sql(body: str, *ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " " + body
