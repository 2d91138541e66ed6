"""Numeric parsing and arithmetic with missing values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from assaymill.functions.genes import strip

NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def to_double(text: Column) -> Column:
    """A number or NULL; rejects the `3d`, `nan` and `inf` spellings a plain cast accepts."""
    bare = strip(text)
    return F.when(bare.rlike(NUMBER), bare.try_cast("double"))


def unquote(text: Column) -> Column:
    """Trim, then drop double quotes at both ends."""
    return _bare(strip(text))


def unquote_all(texts: Column) -> Column:
    """`unquote` of each, with one pass for either step."""
    return F.transform(F.transform(texts, strip), _bare)


def _bare(bare: Column) -> Column:
    plain = ~(bare.endswith("\u0085") | bare.endswith("\u2028") | bare.endswith("\u2029"))  # `$` also stands before these
    return F.when(plain, F.btrim(bare, F.lit('"'))).otherwise(F.regexp_replace(bare, r'^"+|"+$', ""))


def first_int(text: Column) -> Column:
    """First run of digits as INT, else NULL."""
    return F.nullif(F.regexp_extract(text, r"(\d+)", 1), F.lit("")).try_cast("int")


def ratio(a: Column, b: Column) -> Column:
    """a / b, NULL where b is 0."""
    return a / F.nullif(b, F.lit(0.0))
