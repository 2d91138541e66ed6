"""Registered queries of the subpackage against their SQL checks, and plan shapes."""

import pytest

from assaymill.llm import queries
from assaymill.plans import check

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.CHECKS))
def test_query_matches_check(spark, name):
    con = check.connect(SMALL)
    order, got = check.rows_of((df := queries.QUERIES[name](spark, SMALL)).columns, [tuple(r) for r in df.collect()])
    res = con.execute(queries.CHECKS[name])
    want_order, want = check.rows_of([d[0] for d in res.description], res.fetchall())
    assert order == want_order and got == want and got


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_every_query_has_its_number(name):
    assert name.startswith("op") and name[2:].split("_")[0].isdigit()
