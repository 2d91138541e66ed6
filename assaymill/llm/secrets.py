"""Secret scans by corpus-wide ownership of each candidate, in DataFrame operations.

Candidates are the matches of three fixed kinds and of one broad kind (long tokens that mix cases and digits). Every candidate's
value is hashed and the hashes are aggregated over the whole table by distinct owners (`source`) and repositories (documents of
different text: a copied document is no other repository). A value that more than MAX_OWNERS owners or more than MAX_REPOS repositories hold is
a widely copied example; any other looks live, be it in one source or shared by a few. The fixed kinds are always
reported, with that verdict; the broad kind is reported as `owner` only where its value looks live. Texts are scanned once: the candidates
are cut before they are aggregated and judged.

Positions are code points: a text is split by the same pattern that gives its matches, and the lengths of the pieces before a
match add up to its start.

Null and empty texts have no spans. A row with a null owner counts as a repository, but as no owner. Repeated rows get equal results
and count once. Extra columns are kept, those named like an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaymill import session
from assaymill.llm.rowkeys import row_key

#: Kinds in their order, with pattern, group of the value, and least characters of it.
KINDS = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),  # a run of hex digits as a whole, so no shorter match can hide a longer one
    ("owner", r"[A-Za-z0-9_-]{20,}", 0, 20),
]
BASE = ["assign", "access", "hex"]
#: A value in more owners or in more repositories than these is a widely copied example.
MAX_OWNERS = 3
MAX_REPOS = 10

ADDED = ["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_live", "n_copied"]


def _rows(text: Column, pattern: str, group: int) -> Column:
    """(length of the text before, length of the match, value) of every match in order."""
    before = F.transform(F.split(text, pattern, -1), F.length)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    return F.transform(whole, lambda m, i: F.struct(
        F.get(before, i).alias("before"), F.length(m).alias("size"), F.get(value, i).alias("value")))


def _pieces(text: Column) -> Column:
    """For each kind that occurs: its number and its matches."""
    kinds = [F.when(text.rlike(pattern), F.struct(F.lit(number).alias("kind"), _rows(text, pattern, group).alias("rows")))
             for number, (_, pattern, group, _) in enumerate(KINDS)]
    return F.filter(F.array(*kinds), lambda k: k.isNotNull())


def candidates(docs: DataFrame) -> DataFrame:
    """(_key, owner, repo, kind, start, end, value) of all candidates; `docs` has _key, doc_id, source and text."""
    any_kind = None
    for _, pattern, _, _ in KINDS:
        any_kind = F.col("text").rlike(pattern) if any_kind is None else any_kind | F.col("text").rlike(pattern)
    one = docs.where(any_kind).select("_key", F.col("source").cast("string").alias("owner"), F.sha2("text", 256).alias("repo"),
                                      _pieces(F.col("text")).alias("kinds"))
    one = one.dropDuplicates(["_key"]).select("_key", "owner", "repo", F.explode("kinds").alias("k"))
    rows = one.select("_key", "owner", "repo", F.col("k.kind").alias("kind"), F.posexplode("k.rows").alias("at", "m"))
    upto = Window.partitionBy("_key", "kind").orderBy("at")
    end = F.sum(F.col("m.before") + F.col("m.size")).over(upto)
    spans = rows.select("_key", "owner", "repo", "kind", (end - F.col("m.size")).alias("start"), end.alias("end"), F.col("m.value").alias("value"))
    least = F.element_at(F.lit([k[3] for k in KINDS]), F.col("kind") + 1)
    mixed = F.col("value").rlike("[0-9]") & F.col("value").rlike("[a-z]") & F.col("value").rlike("[A-Z]")
    return spans.where((F.length("value") >= least) & ((F.col("kind") < len(BASE)) | mixed))


def ownership(found: DataFrame) -> DataFrame:
    """(hash, n_owners, n_repos) of each candidate value; distinct rows are summed map-side before they meet."""
    return found.select("hash", "owner", "repo").groupBy("hash").agg(
        F.countDistinct("owner").alias("n_owners"), F.countDistinct("repo").alias("n_repos"))


def judged(docs: DataFrame, max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS) -> DataFrame:
    """The candidates with `live`: whether at most `max_owners` owners and `max_repos` repositories hold the value; copied `owner` ones are left out."""
    found = session.cut(candidates(docs).withColumn("hash", F.sha2("value", 256)))
    live = (F.col("n_owners") <= max_owners) & (F.col("n_repos") <= max_repos)
    known = found.join(ownership(found), "hash").withColumn("live", live)
    return known.where((F.col("kind") < len(BASE)) | F.col("live"))


def _joined(spans: Column) -> Column:
    names = F.lit([k[0] for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def _count(spans: str, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def per_row(keyed: DataFrame, max_owners: int, max_repos: int) -> DataFrame:
    """(_key, _spans): the spans of each row with any, by start, then kind."""
    return judged(keyed, max_owners, max_repos).groupBy("_key").agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "end", "live"))).alias("_spans"))


def scan(docs: DataFrame, max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS) -> DataFrame:
    """`docs` without their text, with the ADDED columns."""
    keyed = docs.drop(*ADDED).withColumn("_key", row_key("doc_id", "source"))
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,live:boolean>>")
    out = keyed.drop("text").join(per_row(keyed, max_owners, max_repos), "_key", "left").withColumn("_spans", F.coalesce("_spans", none))
    base = F.filter("_spans", lambda s: s["kind"] < len(BASE))
    for number, name in enumerate(BASE):
        out = out.withColumn(f"n_{name}", _count("_spans", number))
    out = (out.withColumn("base_sha256", F.sha2(_joined(base), 256)).withColumn("spans", _joined(F.col("_spans")))
           .withColumn("n_live", F.size(F.filter("_spans", lambda s: s["live"])).cast("long"))
           .withColumn("n_copied", F.size(F.filter("_spans", lambda s: ~s["live"])).cast("long")))
    return out.select(*[c for c in docs.columns if c not in [*ADDED, "text"]], *ADDED)


def redact(docs: DataFrame, mark: str = "[secret]", max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS) -> DataFrame:
    """`docs` with every live-looking span of a text replaced by `mark`; overlapping spans become one mark."""
    keyed = docs.withColumn("_key", row_key("doc_id", "source"))
    live = per_row(keyed, max_owners, max_repos).select("_key", F.filter("_spans", lambda s: s["live"]).alias("_live")).where(F.size("_live") > 0)
    first = F.filter("_live", lambda s: ~F.exists("_live", lambda o: (o["start"] < s["start"]) & (o["end"] >= s["start"])))
    starts = F.array_sort(F.array_distinct(F.transform(first, lambda s: s["start"])))
    ends = F.transform(starts, lambda a, i: F.array_max(F.transform(F.filter("_live", lambda s: (s["start"] >= a) & (
        F.get(starts, i + 1).isNull() | (s["start"] < F.get(starts, i + 1)))), lambda s: s["end"])))
    marked = live.select("_key", starts.alias("_starts"), ends.alias("_ends"))
    before = F.transform("_starts", lambda a, i: F.substring(
        F.col("text"), (F.coalesce(F.get("_ends", i - 1), F.lit(0)) + 1).cast("int"), (a - F.coalesce(F.get("_ends", i - 1), F.lit(0))).cast("int")))
    rest = F.substring(F.col("text"), (F.array_max("_ends") + 1).cast("int"), F.length("text"))
    text = F.when(F.col("_starts").isNull(), F.col("text")).otherwise(F.concat(F.array_join(F.transform(before, lambda b: F.concat(b, F.lit(mark))), ""), rest))
    return keyed.join(marked, "_key", "left").withColumn("text", text).select(*docs.columns)
