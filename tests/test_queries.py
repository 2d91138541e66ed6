"""Every registered query against its SQL check on the smallest tables."""

import pytest

from assaymill.plans import catalog, check

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    duckdb = pytest.importorskip("duckdb")
    assert duckdb
    return check.connect(SMALL)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_check(spark, con, name):
    text, ok = check.compare(spark, SMALL, name, con)
    # A small table may leave a check without rows; then both sides must be empty.
    assert ok or text == "ok (0 rows)", text


def test_every_query_has_a_check():
    assert set(catalog.CHECKS) == set(catalog.QUERIES)


def test_driver_contract():
    import __spark_entry__ as e
    assert set(e.oracle_sql()) <= set(e.queries()) and len(e.queries()) > 100
