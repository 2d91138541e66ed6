"""Samples to protocol stages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaymill.functions import stages as S
from assaymill.session import settle

MAPPING_COLUMNS = ["geo_sample_id", "protocol_id", "stage_name", "stage_number", "time_point_day",
                   "condition_label", "mapping_confidence", "mapping_method"]


def with_ranges(protocols: DataFrame, name: str = "stage_name", duration: str = "duration_days") -> DataFrame:
    """Protocols with the cumulative day ranges of their stage array."""
    return protocols.withColumn("ranges", S.stage_ranges(F.col("stages"), name, duration))


def stage_rows(protocols: DataFrame) -> DataFrame:
    """One row per stage with its day range."""
    return with_ranges(protocols).select(F.col("id").alias("protocol_id"), F.inline("ranges"))


def stage_of_day(points: DataFrame, protocols: DataFrame, overflow: bool = True) -> DataFrame:
    """Stage of every (protocol_id, day) point; points outside keep a NULL stage.

    The stages travel as one short array per protocol, so the range test adds no rows to the join.
    """
    ranged = with_ranges(protocols).select(F.col("id").alias("protocol_id"), "ranges")
    hit = S.day_to_stage(F.col("day"), F.col("ranges"), overflow)
    return (points.join(ranged, "protocol_id", "left").withColumn("_s", hit)
            .select(*points.columns, F.col("_s.stage_number").alias("stage_number"),
                    F.col("_s.stage_name").alias("stage_name")))


def sample_pairs(samples: DataFrame, accessions: DataFrame, protocols: DataFrame) -> DataFrame:
    """Every sample of a paper's own or ambiguous series with every staged protocol of that paper.

    Day and alias are read from a sample's text once, before it meets its protocols.
    """
    text = S.sample_text(F.col("sample_title"), F.col("source_name"))
    samples = samples.withColumn("day", S.extract_day(text)).withColumn("alias", S.extract_stage_alias(text))
    acc = (accessions.where(F.col("context").isin("own_data", "ambiguous"))
           .select(F.col("id").alias("geo_accession_id"), "paper_id"))
    pr = (with_ranges(protocols.where(F.size("stages") > 0))
          .select(F.col("id").alias("protocol_id"), "paper_id", "ranges"))
    return samples.join(acc, "geo_accession_id").join(pr, "paper_id")


def tier1(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(mapped, unmapped) sample-protocol pairs by day and stage words."""
    tried = pairs.withColumn("_d", S.day_to_stage(F.col("day"), F.col("ranges")))
    tried = tried.withColumn("_a", F.when(F.col("_d").isNull(), S.alias_to_stage(F.col("alias"), F.col("ranges"))))
    tried = tried.withColumn("_m", S.assigned_stage(F.col("day"), F.col("alias"), F.col("_d"), F.col("_a")))
    tried = settle(tried)
    mapped = tried.where(F.col("_m").isNotNull()).select(
        F.col("id").alias("geo_sample_id"), "protocol_id", "_m.*")
    return mapped, tried.where(F.col("_m").isNull()).drop("_m", "_d", "_a")


def tier2(unmapped: DataFrame, answers: DataFrame) -> DataFrame:
    """Mappings of what tier 1 left, from a model's answers `(protocol_id, gsm_id, stage_number, day, ...)`.

    The stage name is looked up by number; an unknown one stays empty.
    """
    a = answers.select(
        "protocol_id", "gsm_id", F.col("stage_number").alias("_n"), F.col("time_point_day").alias("time_point_day"),
        F.coalesce("condition_label", F.lit("")).alias("condition_label"),
        F.coalesce("confidence", F.lit(0.6)).alias("mapping_confidence"))
    j = unmapped.join(a, ["protocol_id", "gsm_id"])
    named = F.get(F.filter("ranges", lambda r: r["stage_number"] == F.col("_n")), F.lit(0))["stage_name"]
    return j.select(
        F.col("id").alias("geo_sample_id"), "protocol_id", F.coalesce(named, F.lit("")).alias("stage_name"),
        F.col("_n").alias("stage_number"), "time_point_day", "condition_label", "mapping_confidence",
        F.lit("tier2_llm").alias("mapping_method"))


def stage_prompt(protocols: DataFrame) -> DataFrame:
    """Stage summary text a model is shown for each protocol."""
    lines = F.transform("ranges", lambda r: F.format_string(
        "  Stage %d: %s (Day %d-%d, %d days)", r["stage_number"], r["stage_name"], r["start_day"], r["end_day"],
        r["duration_days"]))
    return with_ranges(protocols).select(
        F.col("id").alias("protocol_id"),
        F.concat(F.lit("Protocol stages:\n"), F.array_join(lines, "\n"), F.lit("\n")).alias("prompt"))


def sample_lookup(mappings: DataFrame, samples: DataFrame, matrix_titles: DataFrame | None = None) -> DataFrame:
    """(protocol_id, sample_key) -> stage info, where a key is a GSM id, a title, a source or a matrix title.

    On a clash the GSM id wins, except that a sample's title replaces earlier keys; sources and matrix titles
    only fill gaps. The lowest rank is kept by an aggregate, not a window.
    """
    m = mappings.join(samples.select(F.col("id").alias("geo_sample_id"), "gsm_id", "sample_title", "source_name"),
                      "geo_sample_id")
    info = F.struct("gsm_id", "condition_label", "time_point_day", "stage_name")

    def keyed(df, key, rank):
        # Later titles overwrite earlier ones; for the rest the first sample wins.
        order = -F.col("geo_sample_id") if rank == 0 else F.col("geo_sample_id")
        return df.select("protocol_id", F.trim(key).alias("sample_key"), F.lit(rank).alias("rank"),
                         order.alias("pos"), info.alias("info"))

    keys = [keyed(m, F.col("sample_title"), 0), keyed(m, F.col("gsm_id"), 1), keyed(m, F.col("source_name"), 2)]
    if matrix_titles is not None:
        t = m.join(matrix_titles.select("gsm_id", F.col("title").alias("_title")), "gsm_id")
        keys.append(keyed(t, F.col("_title"), 3))
    every = keys[0]
    for k in keys[1:]:
        every = every.unionByName(k)
    every = every.where(F.col("sample_key").isNotNull() & (F.col("sample_key") != ""))
    return (every.groupBy("protocol_id", "sample_key").agg(F.min(F.struct("rank", "pos", "info")).alias("x"))
            .select("protocol_id", "sample_key", "x.info.*"))


def mapped_samples(mappings: DataFrame, samples: DataFrame) -> DataFrame:
    """Mappings with the ids and title of their sample."""
    s = samples.select(F.col("id").alias("geo_sample_id"), "gsm_id", "sample_title", "sra_accession")
    return mappings.join(s, "geo_sample_id")
