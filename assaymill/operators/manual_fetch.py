"""References a person must fetch: manifest, matching dropped files, what to extract again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaymill.functions import text as T
from assaymill.operators.joins import contained_in
from assaymill.operators.ranking import numbered

# How a reference is named in a flag's details.
AUTHOR_YEAR = r"([A-Z][a-z][A-Za-z-]*)(?:\s+(?:et\s+al\.?|and\s+[A-Z][a-z][A-Za-z-]*))?[\s,()]*(\d{4})"
BRACKET = r"(?i)\[(\d+)\]|ref\.?\s*(\d+)|reference\s+(\d+)"


def _group(text: Column, pattern: str, i: int) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, i), F.lit(""))


def resolve_details(flags: DataFrame, refs: DataFrame) -> DataFrame:
    """DOI of flags `(flag_id, path, details)` from the citing paper's references: author and year if exactly one
    reference fits, else the bracketed label."""
    d = flags.select(
        "flag_id", "path", F.lower(_group(F.col("details"), AUTHOR_YEAR, 1)).alias("_author"),
        _group(F.col("details"), AUTHOR_YEAR, 2).alias("_year"),
        F.coalesce(*[_group(F.col("details"), BRACKET, i) for i in (1, 2, 3)]).alias("_label"))
    r = refs.select("path", "doi", "year", "label", "ref_no", F.lower("first_author_surname").alias("_surname"))
    named = d.join(r, (d["path"] == r["path"]) & (d["_year"] == r["year"])
                   & F.contains(r["_surname"], d["_author"])).groupBy("flag_id").agg(
        F.count(F.lit(1)).alias("_n"), F.max("doi").alias("_by_author"))
    named = named.where("_n = 1").drop("_n")
    labelled = d.join(r.where("doi IS NOT NULL"), (d["path"] == r["path"]) & (d["_label"] == r["label"])).groupBy(
        "flag_id").agg(F.min_by("doi", "ref_no").alias("_by_label"))
    return (d.select("flag_id").join(named, "flag_id", "left").join(labelled, "flag_id", "left")
            .select("flag_id", F.coalesce("_by_author", "_by_label").alias("doi")))


def wanted_references(waiting: DataFrame, refs: DataFrame | None = None) -> DataFrame:
    """(key, doi, description, protocol_id, pmc_id) of every reference a waiting protocol needs.

    A protocol's references are the DOIs named in its paywall flags, those its flags resolve to, and its base
    protocol; without any, the first description stands in: a readable slug and a hash of the whole text, so that two
    references that start alike keep their own keys.
    """
    flags = F.filter("incomplete_flags", lambda f: f["reason"] == "behind_paywall_reference")
    w = waiting.withColumn("_details", F.transform(flags, lambda f: F.coalesce(f["details"], F.lit(""))))
    w = w.withColumn("_base", F.nullif(F.trim("base_protocol_doi"), F.lit("")))
    w = w.where((F.size("_details") > 0) | F.col("_base").isNotNull())
    w = w.withColumn("_first", F.get("_details", F.lit(0)))
    named = F.filter(F.transform("_details", T.find_doi), lambda d: d.isNotNull())
    dois = F.concat(named, F.filter(F.array("_base"), lambda d: d.isNotNull()))
    if refs is not None:
        each = w.select("protocol_id", F.col("xml_path").alias("path"), F.posexplode("_details").alias("_i", "details"))
        each = each.where(T.find_doi(F.col("details")).isNull()).withColumn(
            "flag_id", F.struct("protocol_id", "_i"))
        found = resolve_details(each, refs).where("doi IS NOT NULL").groupBy(
            F.col("flag_id.protocol_id").alias("protocol_id")).agg(F.collect_set("doi").alias("_resolved"))
        w = w.join(found, "protocol_id", "left")
        dois = F.concat(dois, F.coalesce("_resolved", F.array().cast("array<string>")))
    w = w.withColumn("_dois", F.array_distinct(dois))
    with_doi = w.select("protocol_id", "pmc_id", F.explode("_dois").alias("doi"), "_first").select(
        F.col("doi").alias("key"), "doi", F.coalesce("_first", F.lit("")).alias("description"), "protocol_id", "pmc_id")
    no_doi = w.where(F.size("_dois") == 0)
    desc = F.coalesce("_first", F.lit("unknown reference"))
    return with_doi.unionByName(no_doi.select(
        F.concat(F.lit("no_doi__"), T.slug(desc), F.lit("_"), F.left(F.md5(desc), F.lit(12))).alias("key"), F.lit(None).cast("string").alias("doi"),
        desc.alias("description"), "protocol_id", "pmc_id"))


def manifest(wanted: DataFrame, previous: DataFrame | None = None, number: bool = True) -> DataFrame:
    """One row per reference with its file name, first description, protocol and paper counts, status and id.

    The protocols of a reference stay in the `wanted` rows: one reference may be needed by most protocols.
    """
    m = wanted.groupBy("key").agg(
        F.max("doi").alias("doi"),
        F.coalesce(F.min_by("description", F.when(F.col("description") != "", F.col("protocol_id"))), F.lit(""))
        .alias("description"),
        F.countDistinct("protocol_id").alias("n_protocols"), F.countDistinct("pmc_id").alias("n_papers"))
    m = m.withColumn("suggested_filename", F.when(
        F.col("doi").isNotNull(), T.doi_filename(F.col("doi"))).otherwise(
        F.concat(F.regexp_replace("key", "^no_doi__", ""), F.lit(".pdf"))))
    if previous is None:
        m = m.withColumn("status", F.lit("pending"))
    else:
        done = previous.where(F.col("status") == "ingested").select("key", F.col("status").alias("_s")).distinct()
        m = m.join(done, "key", "left").withColumn("status", F.coalesce("_s", F.lit("pending"))).drop("_s")
    if not number:
        return m
    return numbered(m, ["key"], "_no").withColumn("id", reference_id(F.col("_no"))).drop("_no")


def reference_id(number: Column) -> Column:
    digits = number.cast("string")
    return F.concat(F.lit("ref_"), F.when(F.length(digits) < 3, F.lpad(digits, 3, "0")).otherwise(digits))


def match_files(files: DataFrame, refs: DataFrame) -> DataFrame:
    """Reference of each dropped file `(filename)`: exact suggested name first, else the first fuzzy match by id.

    A file matches if its name holds a reference's DOI, the DOI's second half or the suggested name, or is
    itself part of the suggested name.
    """
    f = files.select("filename", F.replace(F.lower("filename"), F.lit(".pdf"), F.lit("")).alias("_stem"),
                     F.lower("filename").alias("_name"))
    want = F.replace(F.lower("suggested_filename"), F.lit(".pdf"), F.lit(""))
    r = refs.select(
        "id", "doi", F.lower("suggested_filename").alias("_suggested"), want.alias("_want"),
        F.lower(F.replace("doi", F.lit("/"), F.lit("__"))).alias("_slug"),
        F.nullif(F.lower(F.regexp_extract("doi", r"^[^/]*/(.*)$", 1)), F.lit("")).alias("_suffix"))
    exact = f.join(r, f["_name"] == r["_suggested"]).select("filename", "id", "doi", F.lit(0).alias("_prio"))
    rest = f.join(exact.select("filename"), "filename", "left_anti")
    needles = r.select("id", "doi", F.explode(F.array_distinct(F.array("_slug", "_suffix", "_want"))).alias("_needle"))
    inside = contained_in(rest, "_stem", needles.where("_needle <> ''"), "_needle").select("filename", "id", "doi")
    around = contained_in(r, "_want", rest.select("filename", "_stem"), "_stem").select("filename", "id", "doi")
    fuzzy = inside.unionByName(around).withColumn("_prio", F.lit(1))
    return (exact.unionByName(fuzzy).groupBy("filename").agg(F.min(F.struct("_prio", "id", "doi")).alias("x"))
            .select("filename", "x.id", "x.doi"))


def ingest(matched: DataFrame, texts: DataFrame, refs: DataFrame, min_chars: int = 100) -> tuple[DataFrame, DataFrame]:
    """(cache rows, references with their new status) from matched files and their converted texts."""
    open_refs = refs.where(F.col("status") != "ingested").select("id")
    got = (matched.join(texts, "filename").join(open_refs, "id", "left_semi")
           .where(F.length(F.trim("text")) >= min_chars))
    rows = got.select("doi", F.lit(None).cast("string").alias("pmc_id"), F.lit(None).cast("string").alias("title"),
                      F.col("text").alias("full_text"), F.lit("manual_pdf").alias("source"))
    done = got.groupBy("id").agg(F.max(F.length("text")).alias("text_length"), F.max("filename").alias("ingested_filename"))
    updated = refs.join(done, "id", "left").withColumn(
        "status", F.when(F.col("text_length").isNotNull(), "ingested").otherwise(F.col("status")))
    return rows, updated


def papers_to_extract(wanted: DataFrame, refs: DataFrame, protocols: DataFrame) -> DataFrame:
    """Papers whose missing references have come in."""
    keys = refs.where(F.col("status") == "ingested").select("key")
    ids = wanted.join(keys, "key", "left_semi").select(F.col("protocol_id").alias("id")).distinct()
    return protocols.join(ids, "id", "left_semi").select("paper_id").distinct()
