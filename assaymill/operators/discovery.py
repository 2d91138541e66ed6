"""Accession discovery: mining text and markup, merging hits, scoring, storing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaymill.functions import accessions as A

HIT = ["paper_id", "accession", "context", "source", "surrounding_text", "pos"]


def mine_text(docs: DataFrame, text: str = "text", source: str = "supplement") -> DataFrame:
    """Accessions of a text with their first place and surroundings; supplements are the paper's own material."""
    hits = F.transform(A.find_all(F.col(text)), lambda a: F.struct(
        a.alias("accession"), A.snippet(F.col(text), a).alias("surrounding_text")))
    found = docs.where(F.col(text).rlike(A.ACCESSION)).select("paper_id", F.posexplode(hits).alias("pos", "h"))
    return found.select(
        "paper_id", "h.accession", F.lit("own_data").alias("context"), F.lit(source).alias("source"), "h.surrounding_text", "pos")


def mine_markup(papers: DataFrame) -> DataFrame:
    """Accessions of shredded articles (`paper_id`, `nodes`, `plain`) with the context of where they stand.

    Only elements whose own text or tail holds an accession are looked at; ancestors are found for those alone.
    """
    def own(n):
        return F.concat_ws(" ", F.nullif(n["text"], F.lit("")), F.nullif(n["tail"], F.lit("")))

    def body(m):
        return F.substring("plain", m["start"] + 1, m["length"])

    cites = F.array(*map(F.lit, ["ref-list", "ref", "mixed-citation", "element-citation"]))
    title_of = F.filter("nodes", lambda t: (t["tag"] == "title") & t["text"].rlike(A.AVAILABILITY_TITLES))

    def ancestors(n):
        return F.filter("nodes", lambda m: (m["pos"] < n["pos"]) & (m["stop"] >= n["pos"]))

    def context(n, up):
        in_refs = F.exists(up, lambda m: F.array_contains(cites, m["tag"]))
        in_availability = F.exists(up, lambda m: (m["tag"] == "sec") & (
            F.coalesce(m["attrs"]["sec-type"], F.lit("")).rlike("data[-_]availability")
            | F.exists("_titles", lambda t: t["parent"] == m["pos"])))
        nearest = F.slice(up, F.greatest(F.size(up) - 1, F.lit(1)), F.lit(2))
        around = F.concat_ws(" ", F.when(n["text"] != "", body(n)), F.transform(nearest, body))
        return (F.when(in_refs, "referenced").when(in_availability, "own_data").otherwise(A.context_from_words(around)))

    def placed(n):
        """Node, own text and context of an element; its ancestors are found once."""
        return F.get(F.transform(F.array(ancestors(n)), lambda up: F.struct(
            n["pos"].alias("_node"), own(n).alias("_own"), context(n, up).alias("context"))), F.lit(0))

    found = F.transform(F.filter("nodes", lambda n: own(n).rlike(A.ACCESSION)), placed)
    each = (papers.where("nodes IS NOT NULL").withColumn("_titles", title_of).select("paper_id", F.explode(found).alias("h"))
            .select("paper_id", "h.*").select("*", F.posexplode(A.find_all(F.col("_own"))).alias("_i", "accession")))
    row = F.struct("_node", "_i", "context",
                   A.snippet(F.col("_own"), F.col("accession")).alias("surrounding_text"))
    first = each.groupBy("paper_id", "accession").agg(F.min(row).alias("x"))
    return first.select("paper_id", "accession", "x.context", F.lit("xml").alias("source"), "x.surrounding_text",
                        F.col("x._node").alias("pos"))


def linked_records(links: DataFrame) -> DataFrame:
    """Hits from a link service's answers `(paper_id, accession, title)`: series only, the paper's own."""
    return (links.where(F.col("accession").startswith("GSE")).groupBy("paper_id", "accession")
            .agg(F.max("title").alias("surrounding_text"))
            .select("paper_id", "accession", F.lit("own_data").alias("context"), F.lit("elink").alias("source"),
                    "surrounding_text", F.lit(0).alias("pos")))


# Order in which the strategies run.
STRATEGY_ORDER = ["xml", "supplement", "elink"]


def merge_hits(hits: DataFrame) -> DataFrame:
    """One hit per (paper, accession): best context, the text that came with it, all sources joined by `+`.

    There are at most as many hits per key as strategies, so gathering them is bounded.
    """
    nth = F.array_position(F.array(*map(F.lit, STRATEGY_ORDER)), F.col("source"))
    h = hits.withColumn("_nth", nth).withColumn("_rank", A.context_rank(F.col("context")))
    best = F.min(F.struct((-F.col("_rank")).alias("r"), "_nth", "context", "surrounding_text"))
    g = h.groupBy("paper_id", "accession").agg(
        best.alias("b"), F.array_sort(F.collect_set(F.struct("_nth", "source"))).alias("s"))
    return g.select("paper_id", "accession", "b.context", F.transform("s", lambda x: x["source"]).alias("sources"),
                    F.array_join(F.transform("s", lambda x: x["source"]), "+").alias("source"),
                    F.col("b.surrounding_text").alias("surrounding_text"))


def score_hits(merged: DataFrame, series: DataFrame | None = None, papers: DataFrame | None = None) -> DataFrame:
    """Context upgrade by series records (`accession`, `linked_pmids`, ...) and the confidence of series hits.

    A series that names the paper's PubMed id is the paper's own. One validated series of a paper raises the
    confidence of all its hits.
    """
    h = merged.where(F.col("accession").startswith("GSE"))
    if series is None:
        h = h.withColumn("soft_fetched", F.lit(False)).withColumn("_validated", F.lit(False))
    else:
        s = series.withColumn("_found", F.lit(True))
        h = h.join(s, "accession", "left").join(
            papers.select(F.col("id").alias("paper_id"), "pmid"), "paper_id", "left")
        own = F.coalesce(F.array_contains("linked_pmids", F.col("pmid")), F.lit(False))
        h = h.withColumn("context", F.when(own, "own_data").otherwise(F.col("context")))
        h = h.withColumn("soft_fetched", F.coalesce("_found", F.lit(False))).drop("_found", "pmid")
        valid = h.groupBy("paper_id").agg(F.bool_or("soft_fetched").alias("_validated"))
        h = h.join(valid, "paper_id")
    return h.withColumn("confidence", A.hit_confidence(
        F.col("context"), F.size("sources"), F.col("_validated"))).drop("_validated").withColumnRenamed(
        "accession", "gse_id")


def geo_status(papers: DataFrame, scored: DataFrame) -> DataFrame:
    """Papers with `linked` or `checked_none`."""
    has = scored.select(F.col("paper_id").alias("id"), F.lit("linked").alias("_s")).distinct()
    return papers.join(has, "id", "left").withColumn(
        "geo_status", F.coalesce("_s", F.lit("checked_none"))).drop("_s")
