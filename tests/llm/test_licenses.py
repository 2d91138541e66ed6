"""License scan against brute force."""

import re

import pytest

from assaymill.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, templates, threshold):
    w, places = words(text), []
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(w)) if w[i:i + len(p)] == p]
    share, labels = 0.0, {label for _, label in places}
    lines = (text or "").split("\n")
    for i in range(len(lines)):
        held = set(words("\n".join(lines[i:i + licenses.LINES])))
        for label, t in templates:
            need = set(licenses.template_words(t))
            if len(held & need) >= threshold * len(need) - 1e-9:
                labels.add(label)
                share = max(share, len(held & need) / len(need))
    at = [i for i, _ in places]
    return (len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places})),
            ",".join(sorted(labels)), 1.0 if at else share)


TEXTS = [None, "", "\n\n", "MIT License", "mit license\nApache license, mit-license", "The GNU General\nPublic License here",
         "all RIGHTS reserved", "reserved: all; rights\nno", "Licensed under CC BY-NC 4.0.", "x " * 4000 + "released under the MIT\tlicense",
         "redistribution and use in source and binary forms are permitted with or without", "license license license", "mit licensé", "general public",
         "permission is hereby granted to any person obtaining a copy of this software and associated documentation files free charge",
         "this program is free software you can redistribute it under the terms"]


WRAPPED = [
    ("bsd", " * Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that the following"),
    ("mit", "# Permission is hereby granted, free of charge, to any person obtaining a copy\n# of this software and associated documentation\n# files (the \"Software\"), to deal"),
    ("apache", "// Licensed under the Apache License,\n// Version 2.0 (the \"License\");\n// you may not use this file except in compliance with the License.\n// You may obtain a copy of the License at\n"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided"),
    ("lgpl", "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published"),
]


def test_wrapped_notices(spark):
    rows = [(i, f"code before\n\n{t}\n\nand code after") for i, (_, t) in enumerate(WRAPPED)]
    rows += [(90, "redistribution and use in source\n\n\n\nand binary forms with or without\n\n\nmodification are permitted")]
    got = {r["doc_id"]: r["labels"].split(",") for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(label in got[i] for i, (label, _) in enumerate(WRAPPED)) and got[90] == [""]


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_against_brute_force(spark, threshold):
    rows = [(i, t, 0.5) for i, t in enumerate(TEXTS)] + [(3, "MIT License", 0.5), (None, "MIT license", 0.5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score double")
    got = licenses.scan(df, threshold=threshold).collect()
    assert len(got) == len(rows)
    for r in got:
        text = TEXTS[r["doc_id"]] if r["doc_id"] is not None else "MIT license"
        assert tuple(r[c] for c in licenses.ADDED) == brute(text, licenses.TEMPLATES, threshold), text


def test_empty_table_and_no_python_in_plan(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    out = licenses.scan(df)
    assert out.count() == 0
    text = out._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text and "CartesianProduct" not in text


def test_frequency_order_is_rarest_first(spark):
    df = spark.createDataFrame([("a b",), ("a",), ("a c c c",)], "text string")
    assert licenses.frequency_order(df, ["a", "b", "c", "d"]) == ["d", "b", "c", "a"]
