"""Days, stage aliases and stage day ranges of a differentiation protocol."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from assaymill import dims
from assaymill.functions.numbers import first_int

# Day spellings, tried in this order.
DAY_PATTERNS = [
    r"(?:^|[\s_\-])[Dd]ay[\s_\-]*(\d+)",
    r"(?:^|[\s_\-])[Dd](\d+)(?:[\s_\-]|$)",
    r"(?:^|[\s_\-])(\d+)\s*[Dd](?:[\s_\-]|$)",
    r"\b(\d+)\s*days?\b",
]

RANGE_TYPE = "array<struct<stage_number:int,stage_name:string,start_day:int,end_day:int,duration_days:int>>"


def extract_day(text: Column) -> Column:
    """Day number named in a label, NULL if none."""
    return F.coalesce(*[
        F.nullif(F.regexp_extract(text, p, 1), F.lit("")).try_cast("int") for p in DAY_PATTERNS
    ])


def extract_stage_alias(text: Column) -> Column:
    """Label of the longest stage phrase contained in the text; equal lengths in listed order."""
    low = F.lower(text)
    pairs = sorted(dims.STAGE_ALIASES.items(), key=lambda p: -len(p[0]))
    return F.coalesce(*[F.when(low.contains(phrase), F.lit(label)) for phrase, label in pairs])


def stage_duration(duration: Column) -> Column:
    """Whole days of a duration given as number or text such as `3-5 days`; missing is 0."""
    whole = duration.try_cast("int")
    return F.when(whole >= 0, whole).otherwise(F.coalesce(first_int(duration.cast("string")), F.lit(0)))


def stage_ranges(stages: Column, name: str = "stage_name", duration: str = "duration_days") -> Column:
    """Cumulative inclusive day ranges of an ordered array of stages, in one fold over it."""
    def step(acc, s):
        n, length = acc["n"] + 1, stage_duration(s[duration])
        one = F.struct(
            n.alias("stage_number"),
            F.coalesce(s[name], F.concat(F.lit("stage_"), n.cast("string"))).alias("stage_name"),
            acc["total"].alias("start_day"), (acc["total"] + length).alias("end_day"), length.alias("duration_days"))
        return F.struct(n.alias("n"), (acc["total"] + length).alias("total"),
                        F.concat(acc["out"], F.array(one)).alias("out"))

    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("total"), F.array().cast(RANGE_TYPE).alias("out"))
    return F.aggregate(stages, start, step)["out"]


def day_to_stage(day: Column, ranges: Column, overflow: bool = True) -> Column:
    """Stage a day falls in (earlier stage at a shared boundary); past the end the last one, if overflow."""
    hit = F.get(F.filter(ranges, lambda r: (r["start_day"] <= day) & (day <= r["end_day"])), F.lit(0))
    if not overflow:
        return hit
    last = F.try_element_at(ranges, F.lit(-1))
    return F.coalesce(hit, F.when(day > last["end_day"], last))


def alias_to_stage(alias: Column, ranges: Column) -> Column:
    """Stage whose name holds a keyword of the label; pre-treatment and maturation fall back to the ends."""
    words = F.coalesce(F.try_element_at(
        literal_array_map(dims.STAGE_KEYWORDS), alias), F.array().cast("array<string>"))
    named = F.get(F.filter(
        ranges, lambda r: F.exists(words, lambda w: F.contains(F.lower(r["stage_name"]), w))), F.lit(0))
    before = F.struct(
        F.lit(0).alias("stage_number"), F.lit("pre_treatment").alias("stage_name"),
        F.lit(0).alias("start_day"), F.lit(0).alias("end_day"), F.lit(0).alias("duration_days"))
    some = F.size(ranges) > 0
    return F.coalesce(
        named,
        F.when((alias == "pre_treatment") & some, before),
        F.when((alias == "mature_hepatocyte") & some, F.try_element_at(ranges, F.lit(-1))),
    )


def literal_array_map(mapping: dict) -> Column:
    return F.create_map(*[
        x for k, vs in mapping.items() for x in (F.lit(k), F.array(*[F.lit(v) for v in vs]))])


def sample_text(title: Column, source: Column) -> Column:
    """Text of a sample that names its day and stage."""
    return F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(source, F.lit("")))


def assigned_stage(day: Column, alias: Column, by_day: Column, by_alias: Column) -> Column:
    """Stage assignment of a sample; NULL where neither day nor alias decides.

    All four are columns computed beforehand: inside array functions an expression would run per element.
    """
    def row(stage, at, label, confidence):
        return F.struct(
            stage["stage_name"].alias("stage_name"), stage["stage_number"].alias("stage_number"),
            at.alias("time_point_day"), label.alias("condition_label"),
            F.lit(confidence).alias("mapping_confidence"), F.lit("tier1_regex").alias("mapping_method"))

    return (
        F.when(by_day.isNotNull() & alias.isNotNull(), row(by_day, day, alias, 0.9))
        .when(by_day.isNotNull(), row(by_day, day, by_day["stage_name"], 0.7))
        .when(by_alias.isNotNull(), row(by_alias, by_alias["start_day"], alias, 0.7))
    )
