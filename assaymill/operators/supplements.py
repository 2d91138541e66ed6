"""Supplements: combining the texts of a paper's files, and tables as markdown."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assaymill.functions import text as T
from assaymill.functions.genes import strip
from assaymill.operators.ranking import top_per_group


def with_combined_text(df: DataFrame, budget: int | None = None, name: str = "supplement_text") -> DataFrame:
    """`df` with the text of its ordered `parts` (filename, text), whole unless a budget is given.

    With one, the first block that does not fit is cut if more than 200 characters are left, and ends the text.
    """
    marker = "\n[... truncated ...]\n"
    usable = F.filter("parts", lambda p: strip(F.coalesce(p["text"], F.lit(""))) != "")
    d = df.withColumn("_blocks", F.transform(usable, lambda p: F.concat(
        F.lit("\n## Supplement: "), p["filename"], F.lit("\n\n"), strip(p["text"]), F.lit("\n"))))

    if budget is None:
        return d.withColumn(name, F.array_join("_blocks", "")).drop("_blocks")

    def step(acc, b):
        fits = acc["open"] & (acc["total"] + F.length(b) <= budget)
        return F.struct(
            F.when(fits, acc["total"] + F.length(b)).otherwise(acc["total"]).alias("total"),
            F.when(fits, acc["taken"] + 1).otherwise(acc["taken"]).alias("taken"),
            fits.alias("open"))

    d = d.withColumn("_end", F.aggregate("_blocks", F.struct(
        F.lit(0).alias("total"), F.lit(0).alias("taken"), F.lit(True).alias("open")), step))
    room = F.lit(budget) - F.col("_end.total")
    over = F.get("_blocks", F.col("_end.taken"))
    tail = F.when(over.isNotNull() & (room > 200), F.concat(F.substring(over, F.lit(1), room - 50), F.lit(marker)))
    head = F.array_join(F.slice("_blocks", F.lit(1), F.col("_end.taken")), "")
    return d.withColumn(name, F.concat(head, F.coalesce(tail, F.lit("")))).drop("_blocks", "_end")


def paper_supplements(files: DataFrame, budget: int | None = None) -> DataFrame:
    """(paper_id, supplement_text) from files `(paper_id, filename, text)`, in file name order.

    With a budget only files that can still start within it are gathered: a block has a least length, which bounds
    how many fit, and a running length drops the rest.
    """
    f = files.where(strip(F.coalesce("text", F.lit(""))) != "").withColumn("text", strip(F.col("text")))
    if budget is None:
        every = f.groupBy("paper_id").agg(F.array_sort(F.collect_list(F.struct("filename", "text"))).alias("parts"))
        return with_combined_text(every).drop("parts")
    smallest = len("\n## Supplement: \n\n\n") + 2
    first = top_per_group(f.withColumn("text", F.left("text", F.lit(budget))), ["paper_id"], ["filename"],
                          budget // smallest + 1, ["filename"])
    block = F.length("text") + F.length("filename") + F.lit(smallest - 2)
    before = F.sum(block).over(
        Window.partitionBy("paper_id").orderBy("filename").rowsBetween(Window.unboundedPreceding, -1))
    shown = first.withColumn("_start", F.coalesce(before, F.lit(0))).where(F.col("_start") <= budget).select(
        "paper_id", F.struct("filename", "text").alias("p"))
    parts = shown.groupBy("paper_id").agg(F.array_sort(F.collect_list("p")).alias("parts"))
    return with_combined_text(parts, budget).drop("parts")


def table_markdown(df: DataFrame, key: list[str], order: list[str], columns: list[str], limit: int | None = None) -> DataFrame:
    """Markdown table per key from rows in order; a preview of `limit` rows where one is asked for.

    Row texts are ranked before a preview is gathered, so it never collects more than it shows.
    """
    cells = F.array(*[T.cell(F.col(c).cast("string")) for c in columns])
    rows = df.select(*key, *order, T.markdown_row(cells).alias("line"))
    if limit is not None:
        rows = top_per_group(rows, key, order, limit, order)
    body = rows.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(*order, "line"))).alias("r"))
    head = ["| " + " | ".join(c.replace("|", "\\|").strip() for c in columns) + " |",
            "| " + " | ".join("---" for _ in columns) + " |"]
    return body.select(*key, F.concat_ws(
        "\n", *map(F.lit, head), F.transform("r", lambda x: x["line"])).alias("markdown"))
