"""License scans by an exact set-similarity join of text blocks with license templates, in DataFrame operations.

A block is LINES consecutive lines of a text, as their set of words, so that a notice may be wrapped and may have comment marks. Template T is found in block B where |B and T| >= threshold * |T|. The template
vocabulary is ordered by how many documents of the whole table hold a word, rarest first. With `need` = ceil(threshold * |T|), a
block that meets the threshold holds one of T's first |T| - need + 1 words (prefix filter), has at least `need` words of the
vocabulary (length filter), and after its first word common with T both sides have at least `need` - 1 words left
(positional filter). Pairs that pass are verified. Blocks and template prefixes meet in an equi-join; the template side is
fixed and small, and its size is checked.

Besides, the places of three literal phrases are found: `mit license`, `apache license`, `general public license`.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z. Null and empty texts have no words and no labels. Repeated rows
get equal results; extra columns are kept, those named like an output column are replaced. Ties of score do not matter:
the score is the largest share of a template found, 1 where a phrase stands.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaymill.llm.rowkeys import row_key
from assaymill.session import settle

THRESHOLD = 0.8
#: Lines of a block: the sentences below take no more at the usual widths.
LINES = 3
#: Template words that may be broadcast.
MAX_TEMPLATE_WORDS = 100_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Opening lines of public licenses, with a label of their own.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("all-rights-reserved", "All rights reserved"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("epl", "This program and the accompanying materials are made available under the terms of the Eclipse Public License"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
]

ADDED = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


def lowered(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def words(low: Column) -> Column:
    return F.array_remove(F.split(low, NOT_WORD), "")


def template_words(text: str) -> list[str]:
    """The distinct words of a template (ASCII), in order."""
    return list(dict.fromkeys("".join(c if c.isalnum() else " " for c in text.lower()).split()))


def needed(size: int, threshold: float) -> int:
    return max(1, math.ceil(round(threshold * size, 9)))


def frequency_order(docs: DataFrame, vocabulary: list[str]) -> list[str]:
    """The vocabulary by the number of documents that hold each word, rarest first, ties by the word."""
    held = docs.select(F.explode(F.array_intersect(words(lowered(F.col("text"))), F.lit(vocabulary))).alias("word"))
    found = {r["word"]: r["count"] for r in held.groupBy("word").count().collect()}  # one row per vocabulary word at most
    return sorted(vocabulary, key=lambda w: (found.get(w, 0), w))


def _places(found: Column, phrase: str, label: str) -> Column:
    parts = phrase.split()

    def place(w: Column, i: Column) -> Column:
        here = w == parts[-1]
        for k, part in enumerate(reversed(parts[:-1]), 1):
            here = here & F.when(i >= k, F.get(found, i - k) == part).otherwise(False)
        return F.when(here, F.struct((i - (len(parts) - 1)).cast("long").alias("place"), F.lit(label).alias("label")))

    return F.filter(F.transform(found, place), lambda p: p.isNotNull())


def _phrase_places(found: Column) -> Column:
    """Array of (place, label) of all phrases."""
    return F.concat(*[_places(found, phrase, label) for phrase, label in PHRASES.items()])


def matches(docs: DataFrame, templates=None, threshold: float = THRESHOLD) -> DataFrame:
    """(_key, label, share): every template that a block of a document meets; `docs` has `_key` and `text`."""
    templates = TEMPLATES if templates is None else templates
    sets = [(label, template_words(text)) for label, text in templates]
    vocabulary = sorted({w for _, ws in sets for w in ws})
    if sum(len(ws) for _, ws in sets) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates of over {MAX_TEMPLATE_WORDS} words")
    order = {w: i for i, w in enumerate(frequency_order(docs, vocabulary))}
    index, full = [], []
    for number, (label, ws) in enumerate(sets):
        ranked, need = sorted(order[w] for w in ws), needed(len(ws), threshold)
        full.append((number, label, need, ranked))
        index += [(w, number, i) for i, w in enumerate(ranked[:len(ranked) - need + 1])]
    spark = docs.sparkSession
    prefixes = F.broadcast(spark.createDataFrame(index, "rank int, template int, t_at int"))
    whole = F.broadcast(spark.createDataFrame(full, "template int, label string, need int, t_ranks array<int>"))
    by_rank = sorted(order, key=order.get)
    ranks = F.create_map(*[x for w in by_rank for x in (F.lit(w), F.lit(order[w]))])
    first_words = [by_rank[r] for r in sorted({r for r, _, _ in index})]
    least = min(need for _, _, need, _ in full)
    low = lowered(F.col("text"))
    lines = settle(docs.where(F.arrays_overlap(words(low), F.lit(first_words))).select(
        "_key", F.transform(F.split(low, "\n"), lambda line: F.array_intersect(words(line), F.lit(vocabulary))).alias("_lines")))
    # A block starts at a line that holds some word of the vocabulary; any other adds nothing to the one that starts below it.
    block = F.transform("_lines", lambda own, i: F.when(F.size(own) > 0, F.array_distinct(F.flatten(F.slice("_lines", i + 1, LINES)))))
    blocks = lines.select("_key", F.posexplode(block).alias("block", "held")).where((F.size("held") >= least) & F.arrays_overlap("held", F.lit(first_words)))
    kept = blocks.select("_key", "block", F.sort_array(F.transform("held", lambda w: ranks[w])).alias("ranks"))
    met = kept.select("_key", "block", "ranks", F.posexplode("ranks").alias("b_at", "rank")).join(prefixes, "rank")
    first = met.groupBy("_key", "block", "template").agg(F.min("t_at").alias("t_at"), F.min("b_at").alias("b_at"), F.min("ranks").alias("ranks"))
    overlap = F.size(F.array_intersect("ranks", "t_ranks"))
    return (first.join(whole, "template")
            .where(F.size("ranks") >= F.col("need"))
            .where(F.least(F.size("ranks") - F.col("b_at"), F.size("t_ranks") - F.col("t_at")) >= F.col("need"))
            .where(overlap >= F.col("need"))
            .select("_key", "label", (overlap / F.size("t_ranks")).alias("share")))


def scan(docs: DataFrame, templates=None, threshold: float = THRESHOLD) -> DataFrame:
    """`docs` without their text, with the ADDED columns."""
    keyed = docs.drop(*ADDED).withColumn("_key", row_key("doc_id"))
    found = matches(keyed.select("_key", "text"), templates, threshold)
    per_row = found.groupBy("_key").agg(F.sort_array(F.collect_set("label")).alias("_found"), F.max("share").alias("_share"))
    low = lowered(F.col("text"))
    base = F.when(F.contains(low, F.lit("license")), _phrase_places(F.col("_words"))).otherwise(F.array().cast("array<struct<place:bigint,label:string>>"))
    here = keyed.withColumn("_words", words(low)).select(
        *[c for c in keyed.columns if c != "text"], F.size("_words").cast("long").alias("n_words"), base.alias("_base"))
    labels = F.array_distinct(F.col("_base.label"))
    every = F.array_union(labels, F.coalesce("_found", F.array().cast("array<string>")))
    out = (here.join(per_row, "_key", "left")
           .withColumn("n_base", F.size("_base").cast("long"))
           .withColumn("first_word", F.array_min("_base.place")).withColumn("last_word", F.array_max("_base.place"))
           .withColumn("base_labels", F.array_join(F.array_sort(labels), ",")).withColumn("labels", F.array_join(F.array_sort(every), ","))
           .withColumn("score", F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("_share", F.lit(0.0)))))
    return out.select(*[c for c in docs.columns if c not in [*ADDED, "text"]], *ADDED)
