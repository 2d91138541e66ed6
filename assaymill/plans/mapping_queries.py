"""Days, stages, sample mapping, gene names."""

from __future__ import annotations

from pyspark.sql import functions as F

from assaymill import dims
from assaymill.functions import genes
from assaymill.functions import stages as S
from assaymill.operators import expression as E
from assaymill.operators import mapping
from assaymill.plans import adapters as A
from assaymill.plans.expression_queries import SHOWN, rounded
from assaymill.plans.registry import query


# The check spells the phrases out itself, longest first, so that a wrong table does not pass.
STAGE_SQL = (
    "CASE "
    "WHEN contains({low}, 'hepatic specification') THEN 'hepatic_endoderm' "
    "WHEN contains({low}, 'definitive endoderm') THEN 'definitive_endoderm' "
    "WHEN contains({low}, 'definitive_endoderm') THEN 'definitive_endoderm' "
    "WHEN contains({low}, 'hepatic progenitor') THEN 'hepatoblast' "
    "WHEN contains({low}, 'hepatic_progenitor') THEN 'hepatoblast' "
    "WHEN contains({low}, 'mature hepatocyte') THEN 'mature_hepatocyte' "
    "WHEN contains({low}, 'undifferentiated') THEN 'pre_treatment' "
    "WHEN contains({low}, 'hepatic endoderm') THEN 'hepatic_endoderm' "
    "WHEN contains({low}, 'hepatic_endoderm') THEN 'hepatic_endoderm' "
    "WHEN contains({low}, 'hepatocyte-like') THEN 'mature_hepatocyte' "
    "WHEN contains({low}, 'hepatocyte like') THEN 'mature_hepatocyte' "
    "WHEN contains({low}, 'pluripotent') THEN 'pre_treatment' "
    "WHEN contains({low}, 'hepatoblast') THEN 'hepatoblast' "
    "WHEN contains({low}, 'maturation') THEN 'mature_hepatocyte' "
    "WHEN contains({low}, 'hepatocyte') THEN 'mature_hepatocyte' "
    "WHEN contains({low}, 'stem cell') THEN 'pre_treatment' "
    "WHEN contains({low}, 'endoderm') THEN 'definitive_endoderm' "
    "WHEN contains({low}, 'ipsc') THEN 'pre_treatment' "
    "WHEN contains({low}, 'hesc') THEN 'pre_treatment' "
    "WHEN contains({low}, 'day0') THEN 'pre_treatment' "
    "WHEN contains({low}, 'ihep') THEN 'mature_hepatocyte' "
    "WHEN contains({low}, 'esc') THEN 'pre_treatment' "
    "WHEN contains({low}, 'hlc') THEN 'mature_hepatocyte' "
    "WHEN contains({low}, 'd0') THEN 'pre_treatment' "
    "WHEN contains({low}, 'de') THEN 'definitive_endoderm' "
    "WHEN contains({low}, 'he') THEN 'hepatic_endoderm' "
    "WHEN contains({low}, 'hb') THEN 'hepatoblast' "
    "WHEN contains({low}, 'hp') THEN 'hepatoblast' "
    "END")


def _literal(column: str, low: str) -> str:
    return f"{STAGE_SQL.format(low=low)} AS {column}"


DAY_SQL = ("CAST(COALESCE(NULLIF(regexp_extract({t}, '(?:^|[\\s_\\-])[Dd]ay[\\s_\\-]*(\\d+)', 1), ''), "
           "NULLIF(regexp_extract({t}, '(?:^|[\\s_\\-])[Dd](\\d+)(?:[\\s_\\-]|$)', 1), ''), "
           "NULLIF(regexp_extract({t}, '(?:^|[\\s_\\-])(\\d+)\\s*[Dd](?:[\\s_\\-]|$)', 1), ''), "
           "NULLIF(regexp_extract({t}, '\\b(\\d+)\\s*days?\\b', 1), '')) AS INTEGER)")


@query("stage_ranges", A.sql("SELECT protocol_id, stage_number, stage_name, start_day, end_day, duration_days FROM rg "
                             "WHERE protocol_id IN (SELECT id FROM pr)", A.ST, A.RG, A.PR))
def stage_ranges(spark, sf):
    return mapping.stage_rows(A.staged_protocols(spark, sf))


POINTS = "pt AS (SELECT event_id, user_id AS protocol_id, " + A.DUCK_DAY + " AS day FROM events)"
HITS = ("hit AS (SELECT pt.event_id, pt.protocol_id, pt.day, {pick} FROM pt LEFT JOIN rg ON rg.protocol_id = pt.protocol_id "
        "AND pt.protocol_id IN (SELECT id FROM pr) GROUP BY 1, 2, 3)")
INSIDE = "MIN(CASE WHEN pt.day BETWEEN start_day AND end_day THEN stage_number END)"
LAST = "MAX(CASE WHEN stage_number = n_stages AND pt.day > end_day THEN stage_number END)"


def _points(spark, sf):
    return spark.read.parquet(f"{sf}/events.parquet").selectExpr(
        "event_id", "user_id AS protocol_id", f"{A.SPARK_DAY} AS day")


def _stage_sql(pick):
    return A.sql("SELECT hit.*, rg.stage_name FROM hit LEFT JOIN rg USING (protocol_id, stage_number)",
                 A.ST, A.RG, A.PR, POINTS, HITS.format(pick=pick + " AS stage_number"))


@query("day_to_stage", _stage_sql(f"COALESCE({INSIDE}, {LAST})"))
def day_to_stage(spark, sf):
    return mapping.stage_of_day(_points(spark, sf), A.staged_protocols(spark, sf))


@query("day_to_stage_no_overflow", _stage_sql(INSIDE))
def day_to_stage_no_overflow(spark, sf):
    return mapping.stage_of_day(_points(spark, sf), A.staged_protocols(spark, sf), overflow=False)


@query("extract_day", A.sql("SELECT id, " + DAY_SQL.format(t="sample_title") + " AS day FROM sa", A.SA))
def extract_day(spark, sf):
    return A.samples(spark, sf).select("id", S.extract_day(F.col("sample_title")).alias("day"))


@query("stage_alias", A.sql("SELECT id, " + _literal("alias", "lower(sample_title || ' ' || source_name)") + " FROM sa", A.SA))
def stage_alias(spark, sf):
    text = F.concat_ws(" ", "sample_title", "source_name")
    return A.samples(spark, sf).select("id", S.extract_stage_alias(text).alias("alias"))


# Every sample of user u's series belongs to paper u % 40, whose protocols are those of that customer.
ACC = "acc AS (SELECT DISTINCT user_id AS id, user_id % 40 AS paper_id FROM events WHERE user_id % 3 <> 2)"


def _accessions(spark, sf):
    return spark.read.parquet(f"{sf}/events.parquet").where("user_id % 3 <> 2").selectExpr(
        "user_id AS id", "user_id % 40 AS paper_id",
        "CASE WHEN user_id % 3 = 0 THEN 'own_data' ELSE 'ambiguous' END AS context").distinct()


def _keyword(label, name):
    return " OR ".join(f"contains(lower({name}), '{w}')" for w in dims.STAGE_KEYWORDS[label])


NAMED = "CASE alias " + " ".join(
    f"WHEN '{label}' THEN MIN(CASE WHEN {_keyword(label, 'stage_name')} THEN stage_number END)"
    for label in dims.STAGE_KEYWORDS) + " END"
TIER1 = (
    "sp AS (SELECT sa.id AS geo_sample_id, pr.id AS protocol_id, " + DAY_SQL.format(t="(sample_title || ' ' || source_name)")
    + " AS day, " + _literal("alias", "lower(sample_title || ' ' || source_name)")
    + " FROM sa JOIN acc ON acc.id = sa.geo_accession_id JOIN pr ON pr.paper_id = acc.paper_id), "
    "sg AS (SELECT geo_sample_id, sp.protocol_id, day, alias, COALESCE(MIN(CASE WHEN day BETWEEN start_day AND end_day THEN "
    "stage_number END), MAX(CASE WHEN stage_number = n_stages AND day > end_day THEN stage_number END)) AS by_day, "
    "COALESCE(" + NAMED + ", CASE alias WHEN 'pre_treatment' THEN 0 WHEN 'mature_hepatocyte' THEN MAX(n_stages) END) AS by_alias "
    "FROM sp JOIN rg ON rg.protocol_id = sp.protocol_id GROUP BY 1, 2, 3, 4), "
    "mp AS (SELECT sg.*, COALESCE(by_day, by_alias) AS stage_number FROM sg WHERE by_day IS NOT NULL OR by_alias IS NOT NULL)")


def _tier1(spark, sf):
    pairs = mapping.sample_pairs(A.samples(spark, sf), _accessions(spark, sf), A.staged_protocols(spark, sf))
    return mapping.tier1(pairs)


@query("tier1_mapping", A.sql(
    "SELECT geo_sample_id, mp.protocol_id, CASE WHEN by_day IS NULL AND mp.stage_number = 0 THEN 'pre_treatment' ELSE rg.stage_name END "
    "AS stage_name, CAST(mp.stage_number AS INTEGER) AS stage_number, CAST(CASE WHEN by_day IS NOT NULL THEN day ELSE COALESCE(rg.start_day, 0) END AS INTEGER) "
    "AS time_point_day, CASE WHEN alias IS NOT NULL THEN alias ELSE rg.stage_name END AS condition_label, "
    "CASE WHEN by_day IS NOT NULL AND alias IS NOT NULL THEN CAST(0.9 AS DOUBLE) ELSE CAST(0.7 AS DOUBLE) END AS mapping_confidence, "
    "'tier1_regex' AS mapping_method FROM mp LEFT JOIN rg ON rg.protocol_id = mp.protocol_id AND rg.stage_number = mp.stage_number",
    A.SA, ACC, A.PR, A.ST, A.RG, TIER1))
def tier1_mapping(spark, sf):
    return _tier1(spark, sf)[0]


@query("tier1_unmapped", A.sql(
    "SELECT geo_sample_id, protocol_id FROM sg WHERE by_day IS NULL AND by_alias IS NULL",
    A.SA, ACC, A.PR, A.ST, A.RG, TIER1))
def tier1_unmapped(spark, sf):
    return _tier1(spark, sf)[1].select(F.col("id").alias("geo_sample_id"), "protocol_id")


@query("sample_lookup", A.sql(
    "SELECT protocol_id, sample_key, gsm_id FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY protocol_id, sample_key ORDER BY rk, pos) "
    "AS rn FROM (SELECT protocol_id, sample_title AS sample_key, gsm_id, 0 AS rk, -geo_sample_id AS pos FROM j UNION ALL "
    "SELECT protocol_id, gsm_id, gsm_id, 1, geo_sample_id FROM j UNION ALL SELECT protocol_id, source_name, gsm_id, 2, geo_sample_id FROM j) q) q "
    "WHERE rn = 1", A.SA, "j AS (SELECT geo_accession_id AS protocol_id, id AS geo_sample_id, gsm_id, sample_title, source_name FROM sa)"))
def sample_lookup(spark, sf):
    s = A.samples(spark, sf)
    maps = s.select(F.col("id").alias("geo_sample_id"), F.col("geo_accession_id").alias("protocol_id"),
                    F.lit("x").alias("condition_label"), F.lit(1).alias("time_point_day"), F.lit("s").alias("stage_name"))
    return mapping.sample_lookup(maps, s).select("protocol_id", "sample_key", "gsm_id")


# A mapping per stage row that some day falls in: protocols of the measurements with their stages.
@query("stage_matrix", A.sql(
    "SELECT protocol_id, stage_name, " + ", ".join(
        f"ROUND(AVG(CASE WHEN gene = '{g}' THEN value END), 6) AS \"{g}\"" for g in SHOWN)
    + " FROM ev JOIN st USING (protocol_id) WHERE gene <> 'GAPDH' AND value IS NOT NULL GROUP BY 1, 2", A.EV, A.ST))
def stage_matrix(spark, sf):
    maps = A.stage_rows(spark, sf).select("protocol_id", "stage_name")
    return rounded(E.stage_matrix(A.values(spark, sf), maps, SHOWN), *SHOWN)


@query("stage_matrix_by_day", A.sql(
    "SELECT protocol_id, stage_name, " + ", ".join(
        f"ROUND(AVG(CASE WHEN gene = '{g}' THEN value END), 6) AS \"{g}\"" for g in SHOWN)
    + " FROM ev JOIN (SELECT protocol_id, stage_name, duration_days AS time_point_day FROM st) m USING (protocol_id, time_point_day) "
      "WHERE gene <> 'GAPDH' AND value IS NOT NULL GROUP BY 1, 2", A.EV, A.ST))
def stage_matrix_by_day(spark, sf):
    maps = A.stage_rows(spark, sf).select("protocol_id", "stage_name", F.col("duration_days").alias("time_point_day"))
    return rounded(E.stage_matrix(A.values(spark, sf), maps, SHOWN, by_day=True), *SHOWN)


# Names made of the part table: versioned Ensembl ids, Entrez ids, suffixed and padded symbols, unknown names.
NAMES = ("CASE p_partkey % 8 WHEN 0 THEN 'ENSG00000163898.' || p_size WHEN 1 THEN ' oct4 ' WHEN 2 THEN '213' "
         "WHEN 3 THEN 'ALB_chr' || p_size WHEN 4 THEN 'ntcp' WHEN 5 THEN upper(p_name) WHEN 6 THEN 'CK19_chr1' ELSE 'afp' END")


@query("resolve_alias",
       f"SELECT p_partkey, {NAMES} AS name, CASE p_partkey % 8 WHEN 0 THEN 'ALB' WHEN 1 THEN 'POU5F1' WHEN 2 THEN 'ALB' "
       "WHEN 3 THEN 'ALB' WHEN 4 THEN 'SLC10A1' WHEN 5 THEN upper(p_name) WHEN 6 THEN 'KRT19' ELSE 'AFP' END AS symbol, "
       "p_partkey % 8 <> 5 AS is_target FROM part")
def resolve_alias(spark, sf):
    p = spark.read.parquet(f"{sf}/part.parquet").selectExpr("p_partkey", f"{NAMES} AS name")
    return p.withColumn("symbol", genes.resolve_alias(F.col("name"))).withColumn(
        "is_target", genes.is_target_gene(F.col("name")))
