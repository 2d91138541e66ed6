"""Expression matrices: best value, stage means, coverage, provenance, wide forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaymill import dims
from assaymill.functions import genes
from assaymill.operators.joins import left_lookup


def protocol_key(protocol_id: Column, paper_id: Column) -> Column:
    """Text key of a matrix row: the protocol, or `paper_<id>` for unlinked measurements."""
    return F.coalesce(protocol_id.cast("string"), F.concat(F.lit("paper_"), paper_id.cast("string")))


def first_by(order: list[Column], columns: list[str]) -> Column:
    """Struct of `columns` of the row that comes first in `order`; an aggregate, so it combines map-side."""
    keys = [c.alias(f"_o{i}") for i, c in enumerate(order)]
    return F.min(F.struct(*keys, *[F.col(c) for c in columns]))


def panel_lookup(spark) -> DataFrame:
    """(name_key, symbol) of the panel's spellings: about two hundred fixed rows."""
    rows = ", ".join(f"('{k}', '{v}')" for k, v in genes.lookup_rows())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(name_key, symbol)")


def panel_values(values: DataFrame) -> DataFrame:
    """Measurements of panel genes under their canonical symbol.

    One broadcast hash lookup of a fixed table both filters and renames; the same as nested expressions made
    code too large for the JIT compiler.
    """
    keyed = values.withColumn("name_key", genes.lookup_key(F.col("gene_symbol")))
    hit = keyed.join(F.broadcast(panel_lookup(values.sparkSession)), "name_key")
    return hit.withColumn("gene_symbol", F.col("symbol")).select(*values.columns)


def best_values(values: DataFrame, resolve: bool = True, parity: bool = False) -> DataFrame:
    """Most confident measurement per (protocol or paper, gene); ties go to the lowest id.

    `parity=True` lets unlinked rows of paper n compete with protocol n, as one shared number space.
    """
    if resolve:
        values = panel_values(values)
    if parity:
        key = F.coalesce("protocol_id", "paper_id").cast("string")
    else:
        key = protocol_key(F.col("protocol_id"), F.col("paper_id"))
    keep = ["id", "protocol_id", "paper_id", "value", "unit", "source_type", "source_detail", "confidence",
            "condition_label"]
    best = values.groupBy(key.alias("protocol_key"), "gene_symbol").agg(
        first_by([-F.coalesce(F.col("confidence"), F.lit(0.0)), F.col("id")], keep).alias("b"))
    return best.select("protocol_key", "gene_symbol", *[F.col(f"b.{c}").alias(c) for c in keep])


def widen(long: DataFrame, keys: list[str], value: str = "value", columns: list[str] | None = None) -> DataFrame:
    """Long to wide over a fixed list of genes: conditional aggregates, one shuffle, known columns."""
    columns = columns or dims.PANEL
    return long.groupBy(*keys).agg(*[
        F.max(F.when(F.col("gene_symbol") == g, F.col(value))).alias(g) for g in columns])


def protocol_matrix(values: DataFrame, papers: DataFrame, protocols: DataFrame,
                    columns: list[str] | None = None) -> DataFrame:
    """Protocol x gene matrix of best values with the paper and arm of the row."""
    wide = best_values(values).groupBy("protocol_key").agg(
        F.max("protocol_id").alias("protocol_id"), F.max("paper_id").alias("paper_id"),
        *[F.max(F.when(F.col("gene_symbol") == g, F.col("value"))).alias(g) for g in columns or dims.PANEL])
    p = papers.select(F.col("id").alias("paper_id"), "pmc_id")
    pr = protocols.select(F.col("id").alias("protocol_id"), "protocol_arm")
    return left_lookup(wide.join(p, "paper_id"), pr, ["protocol_id"])


def stage_means(values: DataFrame, mappings: DataFrame, by_day: bool = False) -> DataFrame:
    """Mean per (protocol, stage, gene) over the stages a protocol's samples are mapped to.

    The join is on the protocol, so each of its stages gets the same mean: averaging first and joining the
    distinct stages after gives that without the samples x measurements fan-out. `by_day=True` also joins
    the day, so that a stage only averages its own measurements.
    """
    keys = ["protocol_id"] + (["time_point_day"] if by_day else [])
    v = panel_values(values).where(F.col("value").isNotNull() & F.col("protocol_id").isNotNull())
    sums = v.groupBy(*keys, "gene_symbol").agg(F.sum("value").alias("s"), F.count("value").alias("c"))
    m = mappings.select(*keys, F.coalesce("stage_name", F.lit("unknown")).alias("stage_name"))
    if by_day:
        m = m.groupBy(*keys, "stage_name").agg(F.count(F.lit(1)).alias("w"))
        joined = sums.join(m, keys)
        return joined.groupBy("protocol_id", "stage_name", "gene_symbol").agg(
            (F.sum(F.col("s") * F.col("w")) / F.sum(F.col("c") * F.col("w"))).alias("value"))
    return sums.join(m.distinct(), keys).select(
        "protocol_id", "stage_name", "gene_symbol", (F.col("s") / F.col("c")).alias("value"))


def stage_matrix(values: DataFrame, mappings: DataFrame, columns: list[str] | None = None,
                 by_day: bool = False) -> DataFrame:
    return widen(stage_means(values, mappings, by_day), ["protocol_id", "stage_name"], "value", columns)


def provenance(values: DataFrame) -> DataFrame:
    """Source of the best value of every `<protocol>_<gene>` key, one row per key."""
    b = best_values(values)
    return b.select(
        F.concat_ws("_", "protocol_key", "gene_symbol").alias("key"),
        "source_type", "source_detail", "confidence", "unit", "value")


def min_gene_coverage(best: DataFrame, min_genes: int = 3) -> DataFrame:
    """Protocols whose best values cover at least `min_genes` genes, with the count."""
    covered = best.groupBy("protocol_key").agg(
        F.count(F.when(F.col("value").isNotNull(), 1)).alias("gene_count"))
    return covered.where(F.col("gene_count") >= min_genes)


def gene_coverage(best: DataFrame) -> DataFrame:
    """Number of protocols with a value, per gene."""
    return best.groupBy("gene_symbol").agg(F.count("value").alias("n_protocols"))


def category_coverage(best: DataFrame) -> DataFrame:
    """Number of protocols with a value for any gene of a panel category."""
    member = F.array(*[
        F.struct(F.lit(c).alias("category"), F.array(*map(F.lit, gs)).alias("genes"))
        for c, gs in dims.TARGET_GENES.items()])
    hits = F.transform(
        F.filter(member, lambda m: F.array_contains(m["genes"], F.col("gene_symbol"))), lambda m: m["category"])
    return (best.where(F.col("value").isNotNull())
            .select("protocol_key", F.explode(hits).alias("category"))
            .groupBy("category").agg(F.countDistinct("protocol_key").alias("n_protocols")))


def multi_day_protocols(values: DataFrame, min_days: int = 2) -> DataFrame:
    """Protocols measured on at least `min_days` distinct days."""
    return (values.where(F.col("protocol_id").isNotNull() & F.col("time_point_day").isNotNull())
            .groupBy("protocol_id").agg(F.countDistinct("time_point_day").alias("n_days"))
            .where(F.col("n_days") >= min_days))


def day_means(values: DataFrame) -> DataFrame:
    """Mean per (protocol, day, gene); aliases are resolved before averaging."""
    v = panel_values(values).where(F.col("protocol_id").isNotNull() & F.col("time_point_day").isNotNull())
    return v.groupBy("protocol_id", "time_point_day", "gene_symbol").agg(
        F.avg("value").alias("value"), F.min("paper_id").alias("paper_id"),
        F.min("unit").alias("unit"), F.min("condition_label").alias("condition_label"))


def trajectory_matrix(values: DataFrame, papers: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(protocol, day) x gene means of protocols measured on two days or more."""
    means = day_means(values).join(multi_day_protocols(values).select("protocol_id"), "protocol_id", "left_semi")
    wide = means.groupBy("protocol_id", "time_point_day").agg(
        F.min("paper_id").alias("paper_id"),
        *[F.max(F.when(F.col("gene_symbol") == g, F.col("value"))).alias(g) for g in columns or dims.PANEL])
    return wide.join(papers.select(F.col("id").alias("paper_id"), "pmc_id"), "paper_id").drop("paper_id")


def drop_empty_genes(wide: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Keep only gene columns with a value; one row of counts reaches the driver."""
    columns = [c for c in (columns or dims.PANEL) if c in wide.columns]
    counts = wide.agg(*[F.count(c).alias(c) for c in columns]).first()
    return wide.drop(*[c for c in columns if counts[c] == 0])
