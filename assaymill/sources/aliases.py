"""Alias tables of reagents and markers: from a JSON file, from naming rules, or the built-in ones.

A JSON file is `{category: {canonical: [alias, …]}}`, on any storage that Spark reads.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaymill import reagents

CATEGORY = {"growth_factors": "growth_factor", "small_molecules": "small_molecule", "markers": "marker"}
_GREEK = {"α": ("a", "alpha"), "β": ("b", "beta"), "γ": ("g", "gamma")}


def rule_aliases(name: str) -> list[str]:
    """Spellings of a name: lower case; with and without hyphen or blank before a number; Greek letters spelled out."""
    low = name.lower()
    forms = {low, low.replace("-", ""), low.replace("-", " "), low.replace(" ", "-"),
             re.sub(r"([a-z]{2,})-?(\d+)", r"\1-\2", low, count=1)}
    for letter, spellings in _GREEK.items():
        for f in list(forms):
            if letter in f:
                forms.update(f.replace(letter, s) for s in spellings)
    return sorted(f for f in forms if f)


BUILT_IN = {"growth_factor": reagents.GROWTH_FACTORS, "small_molecule": reagents.SMALL_MOLECULES, "marker": reagents.MARKERS}


def load_alias_tables(path: str | None = None, names: dict[str, list[str]] | None = None) -> dict:
    """Alias tables by report category: of a JSON file, by rule from the names given, or else the built-in ones."""
    if path:
        text = SparkSession.active().read.option("wholetext", True).text(path).first()  # one file of some hundred names
        raw = json.loads(text["value"])
        return {CATEGORY[c]: {k: list(v) for k, v in raw.get(c, {}).items()} for c in CATEGORY}
    if names is None:
        return {c: {k: sorted({k.lower(), *vs}) for k, vs in t.items()} for c, t in BUILT_IN.items()}
    return {c: {n: rule_aliases(n) for n in names.get(c, [])} for c in CATEGORY.values()}


def alias_rows(spark: SparkSession, tables: dict) -> DataFrame:
    """(category, canonical, alias) rows of alias tables."""
    rows = [(c, k, a) for c, t in tables.items() for k, vs in t.items() for a in vs]
    return spark.createDataFrame(rows, "category string, canonical string, alias string")


def entry_terms(answers: DataFrame) -> DataFrame:
    """(uid, term) of thesaurus records `(uid, answer)`: main heading, entry terms, their qualifiers dropped."""
    lines = answers.select("uid", F.explode(F.split("answer", r"\r?\n")).alias("l")).withColumn("l", F.trim("l"))
    after = F.trim(F.regexp_replace("l", r"^[^=]*=", ""))
    term = (F.when(F.col("l").rlike("^Entry Term.*="), after).when(F.col("l").startswith("MH = "), after)
            .when(F.col("l").rlike("^(PRINT )?ENTRY = "), F.trim(F.substring_index(after, "|", 1))))
    return lines.select("uid", term.alias("term")).where("term <> ''")


def build_aliases(terms: DataFrame, names: DataFrame, manual: DataFrame) -> DataFrame:
    """(category, canonical, aliases) from thesaurus terms, `(category, canonical, uid)` and manual rows."""
    own = names.select("category", "canonical", F.lower("canonical").alias("alias"))
    own = own.unionByName(manual.select("category", "canonical", F.lower("canonical").alias("alias")))
    found = names.join(terms, "uid").select("category", "canonical", F.lower("term").alias("alias"))
    every = own.unionByName(found).unionByName(manual.select("category", "canonical", "alias"))
    return every.groupBy("category", "canonical").agg(F.array_sort(F.collect_set("alias")).alias("aliases"))
