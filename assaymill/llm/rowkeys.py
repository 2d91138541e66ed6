"""A key for whole rows, for operators that take a row apart and put results back by a join."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_key(*columns: str, text: str = "text") -> Column:
    """A string that is equal for equal rows only: the short columns as they are, the text by two hashes.

    Repeated rows share a key; whatever is computed per key holds for each of them. Nulls have a spelling of their own.
    """
    short = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null")) for c in columns]
    return F.concat_ws("|", *short, F.hex(F.xxhash64(text)), F.hex(F.hash(text)))
