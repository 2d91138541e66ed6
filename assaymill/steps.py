"""The processing steps as functions from tables to tables, in their usual order.

A step reads DataFrames from a dictionary and returns the ones it changes. `run` writes each changed table as
the next snapshot of its folder, stops at the first failure, and can start anywhere: what is already done is
left out by the worklists, so a second run changes nothing. Fetching and models are callables in `options`.
"""

from __future__ import annotations

import argparse
import logging
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaymill import schemas
from assaymill.operators import (acquire, backfill, crossref, discovery, documents, export, expression, extraction, graph, grounding, mapping,
                                 normalize, readout, references, retrieval, stats, supplements, upserts, worklists)
from assaymill.session import configure, cut
from assaymill.sources import aliases, files, jsonl, matrix, office, snapshots, soft, xml
from assaymill.sources.repositories import fetch

log = logging.getLogger(__name__)
Tables = dict[str, DataFrame]


def bootstrap(t: Tables, o: dict) -> Tables:
    """Import new papers and triage results from the triage log; ids follow from the PMC id."""
    spark = t["papers"].sparkSession
    papers, results = jsonl.import_triage(jsonl.read_triage(spark, o["triage_log"]), t["papers"], o.get("listing"))
    papers = papers.withColumn("id", F.xxhash64("pmc_id"))
    results = results.withColumn("paper_id", F.xxhash64("pmc_id")).drop("pmc_id")
    return {"papers": t["papers"].unionByName(papers, allowMissingColumns=True),
            "triage_results": t["triage_results"].unionByName(results, allowMissingColumns=True)}


def _limited(todo: DataFrame, o: dict) -> DataFrame:
    """A worklist, of one paper or of at most `limit` papers in id order where that is asked for."""
    if o.get("single"):
        todo = todo.where(F.col("pmc_id") == o["single"])
    return todo.orderBy("id").limit(o["limit"]) if o.get("limit") else todo


def _articles(papers: DataFrame, o: dict) -> DataFrame:
    """(paper_id, pmc_id, path, xml) of the given papers (`id`, `pmc_id`); other files are dropped before anything is parsed."""
    pmc = F.regexp_extract("path", r"([^/]+)\.xml$", 1)
    articles = xml.read_articles(papers.sparkSession, o["xml_folder"]).withColumn("pmc_id", pmc)
    return papers.select(F.col("id").alias("paper_id"), "pmc_id").join(articles, "pmc_id")


def convert_text(t: Tables, o: dict) -> Tables:
    """Articles to whole markdown texts; they live in `paper_texts`, the papers point to them."""
    todo = _limited(worklists.needing_text(t["papers"]), o)
    parsed = documents.papers_text(xml.shred(_articles(todo, o).select("path", "xml"), partitions=o.get("partitions")))
    own = F.regexp_extract("path", r"([^/]+)\.xml$", 1)
    texts = cut(todo.select(F.col("id").alias("paper_id"), F.col("pmc_id").alias("_own")).join(
        parsed.where("full_text <> ''").withColumn("_own", own), "_own").select(
        "paper_id", F.col("full_text").alias("text"), "abstract"))
    done = texts.select(F.col("paper_id").alias("id"), F.concat(F.lit("paper_texts/"), "paper_id").alias("parsed_text_path"))
    return {"paper_texts": upserts.append_absent(t["paper_texts"], texts, ["paper_id"]),
            "papers": upserts.patch(t["papers"], done, "id", ["parsed_text_path"])}


def fetch_supplements(t: Tables, o: dict) -> Tables:
    """Supplement files out of the articles' packages below the `package_folder` (`PMC123.tar.gz`), named by the article or by their look.

    A paper whose package holds none is marked `none`; one without a package stays open.
    """
    if not o.get("package_folder"):
        return {}
    spark = t["papers"].sparkSession
    todo = _limited(worklists.supplements_to_fetch(t["papers"]), o).select(F.col("id").alias("paper_id"), "pmc_id")
    owner = F.regexp_extract("path", r"(PMC\d+)[^/]*$", 1)
    packages = files.contents(spark, o["package_folder"], "*.{gz,tgz,tar,zip}").withColumn("pmc_id", owner).join(todo, "pmc_id", "left_semi")
    members = files.archive_members(packages).withColumn("pmc_id", owner)
    manifest = spark.createDataFrame([], "pmc_id string, filename string")
    if o.get("xml_folder"):
        named = documents.supplement_manifest(xml.shred(_articles(todo.withColumnRenamed("paper_id", "id"), o).select("path", "xml"), partitions=o.get("partitions")))
        manifest = named.select(F.regexp_extract("path", r"([^/]+)\.xml$", 1).alias("pmc_id"), "filename")
    found = files.supplement_members(members, manifest).join(todo, "pmc_id").select("paper_id", F.col("name").alias("filename"), "content")
    # Of two members of one name the first in byte order stays.
    found = cut(found.groupBy("paper_id", "filename").agg(F.min("content").alias("content")))
    seen = packages.select("pmc_id").distinct().join(todo, "pmc_id").select(F.col("paper_id").alias("id"))
    held = found.select(F.col("paper_id").alias("id"), F.lit(True).alias("_held")).distinct()
    folder = F.when(F.col("_held"), F.concat(F.lit("supplement_files/"), "id")).otherwise("none")
    done = seen.join(held, "id", "left").select("id", folder.alias("supplement_dir"))
    return {"supplement_files": upserts.append_absent(t["supplement_files"], found, ["paper_id", "filename"]),
            "papers": upserts.patch(t["papers"], done, "id", ["supplement_dir"])}


def read_supplements(t: Tables, o: dict) -> Tables:
    """Supplement texts of each paper, whole and in file name order: fetched files, and those below its folder (`.../PMC123_supp/...`)."""
    spark = t["papers"].sparkSession
    owner = F.regexp_extract("path", r"/(PMC\d+)(?:_supp)?/", 1)
    fetched = t["supplement_files"].where(files.extension(F.col("filename")).isin(files.TEXT_KINDS))
    every = fetched.join(t["papers"].select(F.col("id").alias("paper_id"), "pmc_id"), "paper_id").select(
        "pmc_id", "filename", F.decode("content", "UTF-8").alias("text"))
    if o.get("supplement_folder"):
        every = every.unionByName(files.texts(spark, o["supplement_folder"], "*.{csv,tsv,txt}").select(
            owner.alias("pmc_id"), F.substring_index("path", "/", -1).alias("filename"), F.col("content").alias("text")))
    if o.get("supplement_folder") and o.get("office_converter") is not None:
        blobs = files.contents(spark, o["supplement_folder"], "*.{docx,pptx,pdf}")
        every = every.unionByName(office.convert(blobs, o["office_converter"]).select(
            owner.alias("pmc_id"), F.substring_index("path", "/", -1).alias("filename"), "text"))
    todo = _limited(t["papers"].where("supplement_text_path IS NULL"), o).select(F.col("id").alias("paper_id"), "pmc_id")
    texts = cut(supplements.paper_supplements(todo.join(every, "pmc_id").select("paper_id", "filename", "text")))
    done = texts.select(F.col("paper_id").alias("id"), F.concat(F.lit("paper_supplements/"), "paper_id").alias("supplement_text_path"))
    return {"paper_supplements": upserts.append_absent(t["paper_supplements"], texts, ["paper_id"]),
            "papers": upserts.patch(t["papers"], done, "id", ["supplement_text_path"])}


def order_papers(t: Tables, o: dict) -> Tables:
    """Processing priority from the citation graph."""
    refs = cut(documents.references(xml.shred(_articles(t["papers"].where("pmc_id IS NOT NULL"), o).select("path", "xml"), partitions=o.get("partitions"))))
    own = t["papers"].select(F.col("id").alias("paper_id"), F.col("pmc_id").alias("_own"))
    refs = refs.withColumn("_own", F.regexp_extract("path", r"([^/]+)\.xml$", 1)).join(own, "_own").select(
        "paper_id", "doi", "pmid", "pmc_id")
    order = graph.processing_order(graph.citation_edges(refs, t["papers"]), graph.extractable(t["papers"]))
    return {"papers": upserts.patch(t["papers"], order, "id", ["processing_priority"]),
            "paper_references": t["paper_references"].unionByName(graph.stored_references(refs, t["papers"])).distinct()}


def discover_series(t: Tables, o: dict) -> Tables:
    """Accessions where they stand in articles, in supplements and in link answers, scored, with series records where a transport is given."""
    todo = _limited(worklists.needing_geo(t["papers"]), o)
    ids = todo.select(F.col("id").alias("paper_id"))
    if o.get("xml_folder"):
        hits = discovery.mine_markup(xml.shred(_articles(todo, o).select("paper_id", "xml"), partitions=o.get("partitions")))
    else:  # without markup nothing tells own from cited series
        hits = discovery.mine_text(t["paper_texts"].join(ids, "paper_id", "left_semi"), source="xml").withColumn("context", F.lit("ambiguous"))
    hits = hits.unionByName(discovery.mine_text(t["paper_supplements"].join(ids, "paper_id", "left_semi"), "supplement_text"))
    if o.get("links") is not None:
        hits = hits.unionByName(discovery.linked_records(o["links"].join(ids, "paper_id", "left_semi")))
    merged = discovery.merge_hits(hits)
    series = None
    if o.get("transport"):
        keys = merged.where(F.col("accession").startswith("GSE")).select("accession").distinct()
        answers = fetch(keys, "accession", o["transport"]).withColumnRenamed("answer", "soft").where("soft IS NOT NULL")
        series = soft.series(answers).select("accession", "linked_pmids", "data_type", "platform", "sample_count", "organism")
    scored = discovery.score_hits(merged, series, t["papers"])
    new = scored.withColumn("seq", F.lit(0)).withColumn("discovery_strategies", F.col("sources"))
    new = snapshots.align(new, schemas.TABLES["geo_accessions"]).drop("id").withColumn("seq", F.lit(0))
    rows = upserts.upsert(t["geo_accessions"], new, ["paper_id", "gse_id"], upserts.GEO_ACCESSION)
    rows = rows.withColumn("id", F.xxhash64("paper_id", "gse_id"))
    status = discovery.geo_status(todo, scored).select("id", "geo_status")
    return {"geo_accessions": rows, "papers": upserts.patch(t["papers"], status, "id", ["geo_status"])}


def _sources(t: Tables, o: dict) -> DataFrame:
    """(paper_id, xml, supplement): all that an accession may stand in. The markup itself where there is a folder, else the whole text."""
    known = t["geo_accessions"].select(F.col("paper_id").alias("id")).distinct()
    text = t["paper_texts"].select("paper_id", "text")
    if o.get("xml_folder"):
        papers = t["papers"].select("id", "pmc_id").join(known, "id", "left_semi")
        markup = _articles(papers, o).select("paper_id", "xml")
        text = text.join(markup, "paper_id", "full").select("paper_id", F.coalesce("xml", "text").alias("text"))
    own = t["paper_supplements"].select("paper_id", F.col("supplement_text").alias("supplement"))
    return text.withColumnRenamed("text", "xml").join(own, "paper_id", "full")


def ground_accessions(t: Tables, o: dict) -> Tables:
    """Drop accessions that stand nowhere in their paper or its supplement, with their samples and mappings."""
    verified = grounding.verify_in_text(t["geo_accessions"], _sources(t, o))
    _, doomed = grounding.partition_accessions(t["geo_accessions"], verified)
    a, s, m = upserts.delete_accessions(t["geo_accessions"], t["geo_samples"], t["geo_sample_stage_mappings"], doomed)
    return {"geo_accessions": a, "geo_samples": s, "geo_sample_stage_mappings": m}


def extract_protocols(t: Tables, o: dict) -> Tables:
    """Protocols of pending papers by the `model`: the arms of a paper first, then a protocol for each arm."""
    if not o.get("model"):
        return {}
    prompts = {"structure": "List the protocol arms as JSON.", "arm": "Extract the protocol arm as JSON.", **(o.get("systems") or {})}
    todo = _limited(worklists.for_extraction(t["papers"]), o).select(F.col("id").alias("paper_id"), "title")
    texts = todo.join(t["paper_texts"].select("paper_id", "text"), "paper_id")
    asked = extraction.ask(texts.select(
        "paper_id", F.lit(prompts["structure"]).alias("system"), extraction.structure_prompt(F.col("title"), F.col("text")).alias("prompt")), o["model"])
    arms = cut(extraction.arms(asked.where("call_error IS NULL")))
    per_arm = texts.join(arms, "paper_id").select(
        "paper_id", F.col("arm_id").alias("protocol_arm"), F.lit(prompts["arm"]).alias("system"), extraction.arm_prompt(
            F.col("title"), F.col("arm_id"), F.coalesce("arm_description", F.lit("")), F.col("structure"), F.col("text")).alias("prompt"))
    replies = extraction.ask(per_arm, o["model"]).where("call_error IS NULL").drop("call_error")
    found = cut(extraction.protocols_from_replies(replies, ["paper_id", "protocol_arm"]).withColumn("id", F.xxhash64("paper_id", "protocol_arm")))
    rows = snapshots.align(found, schemas.TABLES["protocols"])
    done = found.select(F.col("paper_id").alias("id")).distinct().withColumn("extraction_status", F.lit("completed"))
    kept = t["protocols"].join(rows.select("id"), "id", "left_anti")
    return {"protocols": kept.unionByName(rows, allowMissingColumns=True),
            "papers": upserts.patch(t["papers"], done, "id", ["extraction_status"])}


def ground_protocols(t: Tables, o: dict) -> Tables:
    """Remove reagents and markers that neither the paper nor its supplement mentions."""
    tables = aliases.load_alias_tables(o.get("alias_file"), o.get("alias_names"))
    texts = t["paper_texts"].select("paper_id", "text").join(t["paper_supplements"], "paper_id", "left")
    g = grounding.note_removals(grounding.ground_protocols(t["protocols"], texts, tables))
    changed = ["stages", "endpoint_assessment", "extraction_notes"]
    return {"protocols": upserts.patch(t["protocols"], g.where(F.size("removals") > 0), "id", changed)}


def map_samples(t: Tables, o: dict) -> Tables:
    """Stage of every sample of a paper's series, by day and alias."""
    todo = worklists.needing_mapping(t["papers"], t["geo_accessions"], t["geo_samples"], t["geo_sample_stage_mappings"])
    acc = t["geo_accessions"].join(todo.select(F.col("id").alias("paper_id")), "paper_id", "left_semi")
    mapped, _ = mapping.tier1(mapping.sample_pairs(t["geo_samples"], acc, t["protocols"]))
    return {"geo_sample_stage_mappings": upserts.upsert(
        t["geo_sample_stage_mappings"], mapped.withColumn("seq", F.lit(0)), ["geo_sample_id", "protocol_id"],
        upserts.SAMPLE_MAPPING)}


def statistics(t: Tables, o: dict) -> Tables:
    """Counters, printed as they are computed."""
    stats.counters(t["papers"], t["protocols"], t["expression_values"], t["geo_accessions"], t["geo_samples"],
                   t["geo_sample_stage_mappings"]).show(50, False)
    return {}


def extract_rnaseq(t: Tables, o: dict) -> Tables:
    """Sequencing metadata of papers by the `model`, one call a paper. A failed call leaves the paper open; an answer that is no JSON closes it."""
    if not o.get("model"):
        return {}
    todo = _limited(worklists.needing_rnaseq(t["papers"]), o).select(F.col("id").alias("paper_id"))
    known = t["geo_accessions"].groupBy("paper_id").agg(F.array_sort(F.collect_set("gse_id")).alias("_known"))
    texts = todo.join(t["paper_texts"].where(F.trim("text") != ""), "paper_id", "left").join(t["paper_supplements"], "paper_id", "left").join(
        known, "paper_id", "left")
    system = (o.get("systems") or {}).get("rnaseq", "Describe the paper's RNA sequencing data as JSON.")
    prompt = extraction.rnaseq_prompt(F.col("text"), F.coalesce("_known", F.array().cast("array<string>")), F.col("supplement_text"))
    asked = cut(extraction.ask(texts.where("text IS NOT NULL").select("paper_id", F.lit(system).alias("system"), prompt.alias("prompt")), o["model"]))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in t["rnaseq_metadata"].schema.fields if f.name in upserts.RNASEQ_METADATA)
    rows = asked.where("call_error IS NULL").select("paper_id", F.from_json("reply", fields).alias("r"), F.try_parse_json("reply").isNotNull().alias("_json"))
    found = cut(rows.where("_json").select("paper_id", "r.*").withColumn("has_rnaseq", F.coalesce("has_rnaseq", F.lit(False))))
    states = rows.select(F.col("paper_id").alias("id"), F.when(F.col("_json") & F.coalesce("r.has_rnaseq", F.lit(False)), "has_rnaseq").otherwise("checked_none").alias("rnaseq_status"))
    silent = texts.where("text IS NULL").select(F.col("paper_id").alias("id"), F.lit("checked_none").alias("rnaseq_status"))
    merged = upserts.upsert(t["rnaseq_metadata"], found.withColumn("seq", F.lit(0)), ["paper_id"], upserts.RNASEQ_METADATA)
    return {"rnaseq_metadata": merged, "papers": upserts.patch(t["papers"], states.unionByName(silent), "id", ["rnaseq_status"])}


def cross_reference(t: Tables, o: dict) -> Tables:
    """Accessions of a paper from all sources and what they make available."""
    llm = t["rnaseq_metadata"].select("paper_id", F.inline("accessions"))
    acc = crossref.collect_accessions(llm, t["geo_accessions"])
    files = t["repository_metadata"].select("accession", F.inline("supplementary_files")).select("accession", "has_count_matrix")
    cls = crossref.classify_availability(acc, files)
    da = F.struct(F.col("data_availability.repository").alias("repository"), F.col("_c").alias("classification"),
                  F.col("_n").alias("n_accessions"))
    j = t["rnaseq_metadata"].join(cls.select("paper_id", F.col("classification").alias("_c"), F.col("n_accessions").alias("_n")),
                                  "paper_id", "left")
    j = j.withColumn("data_availability", F.when(F.col("_c").isNotNull(), da).otherwise(F.col("data_availability")))
    return {"rnaseq_metadata": j.drop("_c", "_n"),
            "repository_metadata": backfill.repository_records(t["repository_metadata"], t["geo_accessions"]),
            "repository_samples": t["repository_samples"].unionByName(backfill.repository_samples(
                t["repository_metadata"], t["geo_accessions"], t["geo_samples"], t["repository_samples"]))}


def retrieve_expression(t: Tables, o: dict) -> Tables:
    """Measurements of papers that have none, each source for what earlier ones left empty; then labels and days that are missing.

    `matrix_folder` holds series matrices and other files of series (`GSE1_…`), `supplement_folder` the papers' own tables.
    """
    v = t["expression_values"]
    spark = v.sparkSession
    todo = cut(acquire.eligible(_limited(t["papers"], o), t["rnaseq_metadata"], v))
    if o.get("matrix_folder"):
        store = acquire.Store(files.lines(spark, o["matrix_folder"], "*_series_matrix*"), files.lines(spark, o["matrix_folder"], "GSE*.{csv,tsv,txt,gz}"))
        geo = todo.where("route = 'geo'")
        lookup = mapping.sample_lookup(t["geo_sample_stage_mappings"], t["geo_samples"], matrix.sample_titles(store.series))
        new = acquire.geo_values(geo, t["geo_accessions"], t["protocols"], t["repository_metadata"], store, lookup)
        v = v.unionByName(_measured(new), allowMissingColumns=True)
    if o.get("supplement_folder"):
        lines = files.lines(spark, o["supplement_folder"], "*.{csv,tsv,txt}")
        new = acquire.supplement_values(todo.where("route = 'supplement'"), t["protocols"], lines)
        v = v.unionByName(_measured(new), allowMissingColumns=True)
    v = backfill.day_from_label(backfill.comparison(cut(v)))
    v = cut(backfill.day_from_mapping(v, t["geo_sample_stage_mappings"]))
    if o.get("export_folder"):
        export.append_jsonl(retrieval.markers_by_paper(v.join(todo, "paper_id", "left_semi"), t["papers"]), f"{o['export_folder']}/markers")
    return {"expression_values": v}


def _measured(rows: DataFrame) -> DataFrame:
    """Measurement rows with an id that follows from their content."""
    shaped = snapshots.align(rows, schemas.TABLES["expression_values"])
    return shaped.withColumn("id", F.xxhash64("paper_id", "protocol_id", "gene_symbol", "condition_label", "comparison", "source_detail"))


def fetch_references(t: Tables, o: dict) -> Tables:
    """Texts of the protocols' base protocols into the text cache: what neither cache nor corpus has is asked of `reference_transport`, once each."""
    if not o.get("reference_transport"):
        return {}
    wanted = t["protocols"].where("trim(base_protocol_doi) <> ''").select(F.trim("base_protocol_doi").alias("doi"), F.lit(None).cast("string").alias("pmid")).distinct()
    texts = t["paper_texts"].select(F.col("paper_id").alias("id"), F.col("text").alias("full_text"))
    _, new = references.fetch_references(wanted, t["corpus_cache"], t["papers"].select("id", "doi", "pmid", "title").join(texts, "id"),
                                         o["reference_transport"], per_second=o.get("reference_rate"))
    return {"corpus_cache": references.written_back(t["corpus_cache"], new)}


def integrate(t: Tables, o: dict) -> Tables:
    """Protocol and stage matrices with normalised values, and the provenance of each value."""
    method = {"rank": "rank", "quantile": "quantile", "relative": "within_study_relative"}[o.get("normalize", "rank")]
    best = expression.best_values(t["expression_values"])
    enough = expression.min_gene_coverage(best, o.get("min_genes", 3))
    long = best.join(enough, "protocol_key", "left_semi").select("protocol_key", "paper_id", "gene_symbol", "value")
    stages = expression.stage_means(t["expression_values"], t["geo_sample_stage_mappings"])
    return {"protocol_matrix": normalize.normalize_across_studies(long, method, ["protocol_key"], ["paper_id"]),
            "stage_matrix": normalize.normalize_across_studies(stages, method, ["protocol_id", "stage_name"], []),
            "provenance": expression.provenance(t["expression_values"])}


def export_sheets(t: Tables, o: dict) -> Tables:
    """The export sheets below the `export_folder`."""
    v, p, pr = t["expression_values"], t["papers"], t["protocols"]
    export.write_sheets({
        "protocols": export.protocols_sheet(pr, p), "stages": export.stages_sheet(pr, p),
        "stage_expression": export.stage_expression_sheet(v, pr, p), "trajectories": expression.trajectory_matrix(v, p),
        "protocol_matrix": expression.protocol_matrix(v, p, pr), "all_expression": export.all_expression_sheet(v, p, pr),
        "rnaseq": export.rnaseq_sheet(t["rnaseq_metadata"], p),
        "repository": export.repository_sheet(t["repository_metadata"], p)}, o["export_folder"])
    return {}


def analyze_readouts(t: Tables, o: dict) -> Tables:
    """All readout tables."""
    r = readout.analyze(t["expression_values"], t["papers"], t["protocols"])
    return {f"readout_{k}": df for k, df in r.items()}


STEPS: list[tuple[float, str, Callable[[Tables, dict], Tables]]] = [
    (1, "bootstrap", bootstrap), (2, "convert_text", convert_text),
    (3, "fetch_supplements", fetch_supplements), (4, "read_supplements", read_supplements),
    (5, "order_papers", order_papers), (6, "discover_series", discover_series), (6.5, "ground_accessions", ground_accessions),
    (7, "extract_protocols", extract_protocols),
    (8, "ground_protocols", ground_protocols), (8.5, "fetch_references", fetch_references), (9, "map_samples", map_samples), (10, "statistics", statistics),
    (11, "extract_rnaseq", extract_rnaseq),
    (12, "cross_reference", cross_reference), (13, "retrieve_expression", retrieve_expression), (14, "integrate", integrate),
    (15, "export", export_sheets), (16, "readouts", analyze_readouts),
]
EXTRA_TABLES = {"paper_texts": "paper_id bigint, text string, abstract string",
                "paper_supplements": "paper_id bigint, supplement_text string",
                "supplement_files": "paper_id bigint, filename string, content binary"}


def load(spark: SparkSession, root: str) -> Tables:
    """All tables below a folder as of the last commit; missing ones are empty."""
    versions = snapshots.committed(spark, root)
    return {n: snapshots.at_commit(spark, root, versions, n, ddl) for n, ddl in {**schemas.TABLES, **EXTRA_TABLES}.items()}


def run(spark: SparkSession, root: str, options: dict, start: float = 0, only: float | None = None) -> list[str]:
    """Run the steps from `start`, or one; returns the names of those that succeeded. A dry run computes and counts, and writes nothing."""
    done = []
    for number, name, step in STEPS:
        if (only is not None and number != only) or (only is None and number < start):
            continue
        try:
            changes = step(load(spark, root), options)
            if options.get("dry_run"):
                for table, df in changes.items():
                    log.info("step %g (%s) would write %d rows to %s", number, name, df.count(), table)
            elif changes:
                snapshots.commit(spark, root, changes)
        except Exception:
            log.exception("step %g (%s) failed; start again from it", number, name)
            break
        done.append(name)
    return done


def main() -> None:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("root", help="folder of the tables")
    p.add_argument("--from-step", type=float, default=0)
    p.add_argument("--only-step", type=float)
    p.add_argument("--triage-log")
    p.add_argument("--xml-folder")
    p.add_argument("--supplement-folder")
    p.add_argument("--package-folder", help="article packages with supplement files")
    p.add_argument("--matrix-folder", help="series matrices and count tables of series")
    p.add_argument("--alias-file")
    p.add_argument("--limit", type=int, help="papers per step at most")
    p.add_argument("--single", help="PMC id of the one paper to work on")
    p.add_argument("--dry-run", action="store_true")
    p.add_argument("--partitions", type=int, help="tasks to deal articles to before parsing")
    p.add_argument("--export-folder", default="exports")
    p.add_argument("--normalize", choices=["rank", "quantile", "relative"], default="rank")
    p.add_argument("--min-genes", type=int, default=3)
    a = p.parse_args()
    spark = configure(SparkSession.builder.appName("assaymill")).getOrCreate()
    wanted = [n for n, _, _ in STEPS if (n == a.only_step if a.only_step is not None else n >= a.from_step)]
    sys.exit(0 if len(run(spark, a.root, vars(a), a.from_step, a.only_step)) == len(wanted) else 1)


if __name__ == "__main__":
    main()
