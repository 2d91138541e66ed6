import pandas as pd
import pytest
from pyspark.sql import functions as F

from assaymill.operators import normalize, ranking

ROWS = [(g, i, v) for g in ("a", "b") for i, v in enumerate([3.0, 1.0, 1.0, None, 0.0, 7.5, 1.0, 3.0, 2.0][: 9 if g == "a" else 5])]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, "gene_symbol string, row int, value double")


def test_percentile_like_pandas(df):
    got = normalize.rank_percentile(df, []).toPandas().sort_values(["gene_symbol", "row"])
    want = pd.DataFrame(ROWS, columns=["gene_symbol", "row", "value"])
    want["norm"] = want.groupby("gene_symbol")["value"].rank(pct=True)
    pd.testing.assert_series_equal(got["norm"].reset_index(drop=True), want["norm"], check_names=False)


def test_quantile_like_pandas(spark):
    wide = pd.DataFrame({"x": [5.0, 2.0, 3.0, 4.0], "y": [4.0, 1.0, 4.0, 2.0], "z": [None, 4.0, 6.0, 8.0]})
    long = wide.reset_index().melt("index", var_name="gene_symbol", value_name="value")
    rows = [(int(i), g, None if v != v else float(v)) for i, g, v in long.itertuples(index=False)]
    got = normalize.quantile(spark.createDataFrame(rows, "row int, gene_symbol string, value double"), ["row"])
    got = {(r["row"], r["gene_symbol"]): r["norm"] for r in got.collect()}
    means = wide.apply(lambda c: c.sort_values().values).mean(axis=1)
    ranks = wide.rank()
    for g in wide.columns:
        for i in wide.index:
            r = ranks.loc[i, g]
            want = None if r != r else means.iloc[int(r) - 1]
            assert got[(i, g)] == pytest.approx(want) if want is not None else got[(i, g)] is None


def test_ranges_follow_the_order_of_values(spark):
    values = [float("-inf"), -1e300, -5.0, -0.5, -0.0, 0.0, 1e-9, 0.5, 0.5000001, 3.0, 1e300, float("inf"), float("nan")]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    parts = [r["p"] for r in df.select(ranking.value_range(F.col("v")).alias("p"), "i").orderBy("i").collect()]
    assert parts == sorted(parts) and None not in parts
    ranks = {r["v"]: (r["below"], r["ties"], r["n"]) for r in ranking.value_ranks(df, [], "v").collect()}
    assert ranks[-5.0] == (2, 1, 13) and ranks[3.0] == (9, 1, 13)


def test_ranks_are_planned_without_a_job(spark, df):
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    ranking.grouped_median(df, ["gene_symbol"], "value", "m"), normalize.rank_percentile(df, []), normalize.quantile(df, ["row"])
    assert len(tracker.getJobIdsForGroup(None)) == before


def test_long_runs_are_cut_up(spark):
    df = spark.createDataFrame([(0, 25, 1.5), (25, 3, 2.0)], "below long, ties long, value double")
    got = sorted((r["pos"], r["value"]) for r in normalize._positions(df, "value", piece=10).collect())
    assert got == [(i, 1.5) for i in range(1, 26)] + [(i, 2.0) for i in range(26, 29)]


def test_median(df):
    got = {r["gene_symbol"]: r["m"] for r in ranking.grouped_median(df, ["gene_symbol"], "value", "m").collect()}
    want = pd.DataFrame(ROWS, columns=["g", "r", "v"]).groupby("g")["v"].median().to_dict()
    assert got == want


def test_relative_zero_maximum(spark):
    df = spark.createDataFrame([("g", 0.0), ("g", None)], "gene_symbol string, value double")
    assert {r["norm"] for r in normalize.within_group_relative(df, []).collect()} == {None}


def test_unknown_method(df):
    out = normalize.normalize_across_studies(df, "other", ["row"], [])
    assert out.where("norm IS NOT NULL").count() == 0


def test_numbered_is_dense(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 7)
    rows = ranking.numbered(df, ["k", "id"], "n").orderBy("n").collect()
    assert [r["n"] for r in rows] == list(range(1, 1001))
    assert [(r["k"], r["id"]) for r in rows] == sorted((i % 7, i) for i in range(1000))


def test_top_per_group(spark):
    df = spark.range(1000).withColumn("g", F.col("id") % 2)
    got = sorted((r["g"], r["id"], r["rn"]) for r in ranking.top_per_group(df, ["g"], [F.desc("id")], 3, ["id"], "rn").collect())
    assert got == [(0, 994, 3), (0, 996, 2), (0, 998, 1), (1, 995, 3), (1, 997, 2), (1, 999, 1)]


@pytest.mark.parametrize("chunk", [2, 100])
def test_record_breakers(spark, chunk):
    vals = [3, 1, 4, 4, 1, 5, 9, 2, 6]
    df = spark.createDataFrame([("k", i, v) for i, v in enumerate(vals)], "k string, i long, v int")
    assert sorted(r["i"] for r in ranking.record_breakers(df, ["k"], "i", "v", chunk).collect()) == [0, 2, 5, 6]
