"""Readable one-line forms of reagents, markers, assays and stages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _joined(items: Column, fmt) -> Column:
    parts = F.filter(F.transform(items, fmt), lambda x: x.isNotNull() & (x != ""))
    return F.coalesce(F.array_join(parts, "; "), F.lit(""))


def reagents(items: Column, name="name", concentration="concentration", unit="unit") -> Column:
    """`Name (conc unit); ...` of an array of structs."""
    def one(r):
        label = F.coalesce(r[name], F.lit(""))
        full = F.concat(label, F.lit(" ("), r[concentration].cast("string"), F.lit(" "),
                        F.coalesce(r[unit], F.lit("")), F.lit(")"))
        return F.when(r[concentration].isNotNull(), F.trim(full)).otherwise(label)
    return _joined(items, one)


def markers(items: Column, name="marker_name", value="value") -> Column:
    def one(m):
        label = F.coalesce(m[name], F.lit(""))
        shown = F.nullif(m[value].cast("string"), F.lit(""))
        return F.when(shown.isNotNull(), F.concat(label, F.lit(": "), shown)).otherwise(label)
    return _joined(items, one)


def assays(items: Column, name="assay_name", value="value", unit="unit") -> Column:
    def one(a):
        label = F.coalesce(a[name], F.lit(""))
        shown = F.concat_ws(" ", a[value].cast("string"), F.coalesce(a[unit], F.lit("")))
        return F.when(a[value].isNotNull(), F.trim(F.concat(label, F.lit(": "), shown))).otherwise(label)
    return _joined(items, one)


def stage_summary(stages: Column) -> Column:
    """One line per stage: `name (Nd): factor, factor`."""
    def one(s):
        names = F.concat(
            F.coalesce(F.transform(s["growth_factors"], lambda g: g["name"]), F.array().cast("array<string>")),
            F.coalesce(F.transform(s["small_molecules"], lambda g: g["name"]), F.array().cast("array<string>")))
        factors = F.array_join(names, ", ")
        head = F.concat(F.coalesce(s["stage_name"], F.lit("unknown")), F.lit(" ("),
                        F.coalesce(s["duration_days"].cast("string"), F.lit("?")), F.lit("d)"))
        return F.when(factors != "", F.concat(head, F.lit(": "), factors)).otherwise(head)
    return F.transform(stages, one)
