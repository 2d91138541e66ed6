"""Citation graph: edge resolution, cycle breaking and processing order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaymill import dims
from assaymill.operators.joins import left_lookup
from assaymill.operators.ranking import numbered
from assaymill.session import cut


def _owner(papers: DataFrame, column: str) -> DataFrame:
    """id of the paper that owns an identifier; of several the last."""
    return (papers.where(F.col(column).isNotNull() & (F.col(column) != ""))
            .groupBy(F.col(column).alias(f"_{column}")).agg(F.max("id").alias(f"_id_{column}")))


def resolve_references(refs: DataFrame, papers: DataFrame, by=("doi", "pmid", "pmc_id")) -> DataFrame:
    """References `(paper_id, doi, pmid, pmc_id)` with the in-corpus paper they name, identifiers in order."""
    j = refs
    for c in by:
        j = left_lookup(j, _owner(papers, c).withColumnRenamed(f"_{c}", c), [c])
    ref = F.coalesce(*[F.col(f"_id_{c}") for c in by])
    return (j.withColumn("referenced_id", ref).drop(*[f"_id_{c}" for c in by])
            .withColumn("in_corpus", F.col("referenced_id").isNotNull()))


def stored_references(refs: DataFrame, papers: DataFrame) -> DataFrame:
    """Rows of the reference table: resolved by DOI, then PMC id; one row per reference, however often added."""
    r = resolve_references(refs, papers, ("doi", "pmc_id"))
    return r.select("paper_id", F.col("doi").alias("referenced_doi"), F.col("pmc_id").alias("referenced_pmc_id"),
                    "referenced_id", "in_corpus", F.col("in_corpus").alias("resolved")).distinct()


def extractable(papers: DataFrame) -> DataFrame:
    return papers.where(F.col("triage_category").isin(dims.EXTRACTABLE + [dims.REVIEW])
                        & F.col("xml_path").isNotNull()).select("id")


def citation_edges(refs: DataFrame, papers: DataFrame) -> DataFrame:
    """(src, dst): the cited paper comes before the citing one; self-citations and papers outside are dropped."""
    nodes = extractable(papers)
    r = resolve_references(refs, papers).where(F.col("referenced_id") != F.col("paper_id"))
    e = r.select(F.col("referenced_id").alias("src"), F.col("paper_id").alias("dst")).distinct()
    return (e.join(nodes.withColumnRenamed("id", "src"), "src", "left_semi")
            .join(nodes.withColumnRenamed("id", "dst"), "dst", "left_semi"))


def _empty(df: DataFrame) -> bool:
    return not df.take(1)


#: Rounds of a graph computation that one job does before anything is asked of its outcome; a plan doubles with each.
ROUNDS = 2


#: Nodes are hung while at least one edge in this many leads to such a node.
WORTH = 8


def _hang(edges: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """Take off every node with one predecessor: (nodes off `(id, root, dist)`, the edges `(src, dst, w)` between the others).

    Such a node's level is its predecessor's plus the edge's weight, so it hangs from the first node above it that has none or several
    predecessors. Pointer doubling finds that root in as many rounds as the logarithm of the longest chain. Chains that
    end nowhere are cycles: their nodes stay, with an edge to themselves that keeps them from being peeled.
    """
    one = edges.groupBy("dst").agg(F.count("*").alias("n"), F.min("src").alias("to"), F.max("w").alias("dist"))
    pointers = cut(one.where("n = 1 AND `to` <> dst").select(F.col("dst").alias("id"), "to", "dist"))
    n = pointers.count()
    if n * WORTH < edges.count() or not n:  # few nodes to hang: peeling is no dearer
        return None
    ids = pointers.select("id")
    for _ in range(n.bit_length() + 1):
        further = pointers.select(F.col("id").alias("to"), F.col("to").alias("_to"), F.col("dist").alias("_dist"))
        found = cut(pointers.join(further, "to", "left").select(
            "id", F.coalesce("_to", "to").alias("to"), (F.col("dist") + F.coalesce("_dist", F.lit(0))).alias("dist"), F.col("_to").isNotNull().alias("moved")))
        pointers = found.drop("moved")
        if _empty(found.where("moved")):
            break
    endless = cut(pointers.join(ids.withColumnRenamed("id", "to"), "to", "left_semi").select("id"))
    hung = cut(pointers.join(endless, "id", "left_anti").select("id", F.col("to").alias("root"), "dist"))
    up = hung.select(F.col("id").alias("src"), "root", "dist")
    rest = (edges.join(ids.withColumnRenamed("id", "dst"), "dst", "left_anti").join(up, "src", "left")
            .select(F.coalesce("root", "src").alias("src"), "dst", (F.col("w") + F.coalesce("dist", F.lit(0))).alias("w")))
    rest = rest.unionByName(endless.select(F.col("id").alias("src"), F.col("id").alias("dst"), F.lit(1).cast("bigint").alias("w")))
    return hung, cut(rest.groupBy("src", "dst").agg(F.max("w").alias("w")))


def _peel(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((id, level) by the longest weighted path, the ids left on and behind cycles), sources first, ROUNDS levels in a job.

    A node carries how many of its predecessors are still to come; it is sent on once that is none. One aggregation adds up what it gets.
    """
    ends = edges.select(F.col("src").alias("id"), F.lit(0).cast("bigint").alias("open")).unionByName(
        edges.select(F.col("dst").alias("id"), F.lit(1).cast("bigint").alias("open")))
    nodes = ends.groupBy("id").agg(F.sum("open").alias("open")).withColumn("level", F.lit(0).cast("bigint"))
    nodes = cut(nodes.withColumn("fresh", F.col("open") == 0))
    while not nodes.where("fresh").isEmpty():
        for _ in range(ROUNDS):
            free = nodes.where("fresh").select(F.col("id").alias("src"), "level")
            sent = edges.join(free, "src").select(F.col("dst").alias("id"), F.lit(-1).cast("bigint").alias("open"), (F.col("level") + F.col("w")).alias("level"),
                                                  F.lit(True).alias("fresh"))
            nodes = nodes.withColumn("fresh", F.lit(False)).unionByName(sent).groupBy("id").agg(
                F.sum("open").alias("open"), F.max("level").alias("level"), F.max("fresh").alias("fresh"))
            nodes = nodes.withColumn("fresh", F.col("fresh") & (F.col("open") == 0))
        nodes = cut(nodes)
    return nodes.select("id", "level"), nodes.where("open > 0").select("id")


def _levels(edges: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """((id, level) of the nodes of `edges`, the ids on or behind a cycle, None if there is none)."""
    rest, off = cut(edges.select("src", "dst", F.lit(1).cast("bigint").alias("w"))), []
    while (step := _hang(rest)) is not None:
        off.append(step[0])
        rest = step[1]
    levels, left = _peel(rest)
    stuck = None if left.isEmpty() else cut(left)
    for hung in reversed(off):
        roots = hung.select(F.col("root").alias("id")).distinct().join(levels.select("id"), "id", "left_anti")
        levels = levels.unionByName(roots.withColumn("level", F.lit(0).cast("bigint")))
        own = hung.join(levels.withColumnRenamed("id", "root"), "root").select("id", (F.col("level") + F.col("dist")).alias("level"))
        if stuck is not None:
            stuck = cut(stuck.unionByName(hung.join(stuck.withColumnRenamed("id", "root"), "root", "left_semi").select("id")))
        levels = cut(levels.unionByName(own))
    return levels, stuck


def _spread(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Largest colour that reaches each node along edges (src -> dst), until nothing changes; ROUNDS steps in a job."""
    while True:
        begun = nodes
        for _ in range(ROUNDS):
            sent = edges.join(nodes.select(F.col("id").alias("src"), "colour"), "src").select(F.col("dst").alias("id"), "colour")
            nodes = nodes.unionByName(sent).groupBy("id").agg(F.max("colour").alias("colour"))
        nodes = cut(nodes)
        if nodes.join(begun.withColumnRenamed("colour", "_old"), "id").where("colour > _old").isEmpty():
            return nodes


def strongly_connected(edges: DataFrame) -> DataFrame:
    """(id, component) of the nodes on edges that peeling could not remove, by forward-backward colouring."""
    found = None
    left = cut(edges)
    while not _empty(left):
        ids = left.select(F.col("src").alias("id")).union(left.select("dst")).distinct()
        colours = _spread(ids.withColumn("colour", F.col("id")), left)
        # Walk backwards inside a colour from its root: those nodes reach the root and are reached by it.
        inner = (left.join(colours.select(F.col("id").alias("src"), F.col("colour").alias("_cs")), "src")
                 .join(colours.select(F.col("id").alias("dst"), F.col("colour").alias("_cd")), "dst")
                 .where("_cs = _cd").select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        roots = colours.select("id", F.when(F.col("id") == F.col("colour"), F.col("colour"))
                               .otherwise(F.lit(-1)).alias("colour"), F.col("colour").alias("_own"))
        back = _spread(roots.select("id", "colour"), cut(inner))
        got = cut(back.where("colour >= 0").join(colours.withColumnRenamed("colour", "_own"), "id")
                  .where("colour = _own").select("id", F.col("colour").alias("component")))
        found = got if found is None else found.unionByName(got)
        left = cut(left.join(got.select(F.col("id").alias("src")), "src", "left_anti")
                   .join(got.select(F.col("id").alias("dst")), "dst", "left_anti"))
    return found


def break_cycles(edges: DataFrame) -> DataFrame:
    """Edges without cycles: inside a cycle's component the edges from a higher to a lower id go.

    Every cycle has such an edge, and edges between components all stay.
    """
    _, stuck = _levels(edges)
    return edges if stuck is None else _without_cycles(edges, stuck)


def _without_cycles(edges: DataFrame, stuck: DataFrame) -> DataFrame:
    core = edges.join(stuck.select(F.col("id").alias("src")), "src", "left_semi").join(stuck.select(F.col("id").alias("dst")), "dst", "left_semi")
    core = cut(core.select("src", "dst"))
    comp = strongly_connected(core)
    marked = (core.join(comp.select(F.col("id").alias("src"), F.col("component").alias("_a")), "src")
              .join(comp.select(F.col("id").alias("dst"), F.col("component").alias("_b")), "dst"))
    drop = marked.where("_a = _b AND src >= dst").select("src", "dst")
    return cut(edges.join(drop, ["src", "dst"], "left_anti"))


def topological_levels(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """(id, level) with level the longest path that ends at the node; nodes without edges get level 0.

    Chains and trees of any depth take a number of jobs that grows with the logarithm of the depth; what is left after them is peeled
    several levels in a job.
    """
    edges = cut(edges.where(F.col("src") != F.col("dst")).select("src", "dst").distinct())
    levels, stuck = _levels(edges)
    if stuck is not None:
        levels, _ = _levels(_without_cycles(edges, stuck))
    ids = edges.select(F.col("src").alias("id")).union(edges.select("dst"))
    if nodes is not None:
        ids = ids.union(nodes.select("id"))
    return ids.distinct().join(levels, "id", "left").select("id", F.coalesce("level", F.lit(0)).cast("int").alias("level"))


def processing_order(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(id, processing_priority): papers after everything they cite, ids within a level ascending."""
    levels = topological_levels(edges, nodes)
    ordered = numbered(levels, ["level", "id"], "processing_priority", start=0)
    return ordered.select("id", F.col("processing_priority").cast("int").alias("processing_priority"))
