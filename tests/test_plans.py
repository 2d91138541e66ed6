"""Shapes of the physical plans that must hold at scale."""

import pytest

from assaymill.plans import catalog

SMALL = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_pairwise_join(spark, name):
    text = plan(catalog.QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_columns_and_filters_reach_the_scan(spark):
    from pyspark.sql import functions as F

    from assaymill.operators import expression
    from assaymill.plans import adapters
    text = plan(expression.multi_day_protocols(adapters.values(spark, SMALL)))
    assert "props" not in text.split("ReadSchema")[1].split("\n")[0]
    papers = spark.read.parquet(f"{SMALL}/orders.parquet").where(F.col("o_orderstatus") == "F").select("o_orderkey")
    assert "EqualTo(o_orderstatus,F)" in plan(papers)


def test_panel_lookup_is_broadcast_and_partial(spark):
    text = plan(catalog.QUERIES["best_value_per_protocol_gene"](spark, SMALL))
    assert "BroadcastHashJoin" in text and "partial_min" in text


def test_sample_is_thinned_before_its_final_window(spark):
    text = plan(catalog.QUERIES["audit_sample"](spark, SMALL))
    assert "WindowGroupLimit" in text
