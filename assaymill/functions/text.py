"""Small text expressions: sections, DOIs, labels, cells, notes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from assaymill import dims
from assaymill.functions.genes import literal_map, strip

TRUNCATED = "\n[... truncated ...]"


def section_class(title: Column) -> Column:
    low = F.lower(title)
    kinds = [F.when(low.rlike("|".join(words)), F.lit(kind)) for kind, words in dims.SECTION_WORDS.items()]
    return F.coalesce(*kinds, F.lit("results"))


def section_priority(title: Column) -> Column:
    return F.coalesce(F.try_element_at(literal_map(dims.SECTION_PRIORITY), section_class(title)), F.lit(2))


def truncate(text: Column, budget: int, marker: str = TRUNCATED) -> Column:
    return F.when(F.length(text) > budget, F.concat(F.left(text, F.lit(budget)), F.lit(marker))).otherwise(text)


def normalize_doi(text: Column) -> Column:
    return F.regexp_replace(text, r"https?://doi\.org/", "")


def looks_like_doi(text: str) -> bool:
    return text.startswith("10.") or "doi.org" in text


def find_doi(text: Column) -> Column:
    """First DOI in the text without its closing full stop, else NULL."""
    hit = F.regexp_extract(text, r"(10\.\d{4,}/[^\s,;)\]]+)", 1)
    return F.nullif(F.regexp_replace(hit, r"\.+$", ""), F.lit(""))


def doi_filename(doi: Column) -> Column:
    return F.concat(F.replace(doi, F.lit("/"), F.lit("__")), F.lit(".pdf"))


def _slugged(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text), r"[^a-z0-9]+", "_"), r"^_+|_+$", "")


def slug(text: Column) -> Column:
    """`author_year` of the first citation-like phrase, else the first 40 characters."""
    cite = r"([A-Z][a-z-]+(?:\s+et\s+al\.?)?)\s*[\[(]?\s*(\d{4})"
    author = F.regexp_replace(strip(F.regexp_extract(text, cite, 1)), r"\.+$", "")
    cited = _slugged(F.concat_ws("_", author, F.regexp_extract(text, cite, 2)))
    plain = F.nullif(_slugged(F.left(text, F.lit(40))), F.lit(""))
    return F.when(text.rlike(cite), cited).otherwise(F.coalesce(plain, F.lit("unknown_ref")))


def comparison_label(name: Column) -> Column:
    """`a vs b` of a file name such as `DEG_a_vs_b.csv`, else NULL."""
    p = r"(?i)(\w+)[-_]vs[-_](\w+)"
    return F.when(name.rlike(p), F.concat(F.regexp_extract(name, p, 1), F.lit(" vs "), F.regexp_extract(name, p, 2)))


def detail_file(detail: Column) -> Column:
    """What follows the last `: `, else NULL."""
    return F.when(detail.contains(": "), F.substring_index(detail, ": ", -1))


def cell(text: Column) -> Column:
    """Markdown-safe table cell; missing is empty."""
    safe = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" "))
    return F.trim(safe)


def markdown_row(cells: Column) -> Column:
    return F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))


def append_note(old: Column, note: Column) -> Column:
    """`old | note`, stripped of bars and blanks at both ends."""
    joined = F.concat_ws(" | ", F.nullif(old, F.lit("")), note)
    return F.regexp_replace(joined, r"^[ |]+|[ |]+$", "")


def methods_snippet(text: Column, width: int | None = None) -> Column:
    """The text from its methods heading on, else from the start; `width` characters of it where that is given."""
    # Headings, tried in this order.
    heads = ["## Methods", "## Materials and Methods", "## METHODS", "## Experimental Procedures",
             "## Materials and methods"]
    at = F.coalesce(*[F.nullif(F.instr(text, F.lit(h)), F.lit(0)) for h in heads], F.lit(1))
    return F.substring(text, at, F.length(text) if width is None else F.lit(width))


def balanced_json(text: Column) -> Column:
    """The outermost `{...}` that closes first, as text; NULL where none closes."""
    opened = F.instr(text, F.lit("{"))
    tail = F.when(opened > 0, F.substring(text, opened, F.length(text)))
    pieces = F.regexp_extract_all(tail, F.lit(r"[^{}]*[{}]"), F.lit(0))
    # The closing brace ends the first piece at which the running sum of braces is zero.
    state = F.aggregate(
        pieces,
        F.struct(F.lit(0).alias("depth"), F.lit(0).alias("seen"), F.lit(0).alias("stop")),
        lambda s, p: F.struct(
            (s["depth"] + F.when(p.endswith("{"), 1).otherwise(-1)).alias("depth"), (s["seen"] + 1).alias("seen"),
            F.when((s["stop"] == 0) & p.endswith("}") & (s["depth"] == 1), s["seen"] + 1)
            .otherwise(s["stop"]).alias("stop")),
    )
    return F.when(state["stop"] > 0, F.array_join(F.slice(pieces, F.lit(1), state["stop"]), ""))


def salvage_json(text: Column) -> Column:
    """JSON object in a reply: the reply itself, a fenced block, or the first balanced braces; as text."""
    def valid(t):
        return F.when(F.try_parse_json(t).isNotNull(), t)

    fenced = F.nullif(F.regexp_extract(text, r"(?s)```(?:json)?\s*\n(.*?)\n```", 1), F.lit(""))
    return F.coalesce(valid(text), valid(fenced), valid(balanced_json(text)))
