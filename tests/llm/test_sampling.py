"""The bounded sample."""

from pyspark.sql import functions as F

from assaymill.llm import sampling


def test_sample_is_bounded_repeatable_and_distinct(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") % 7).alias("x"))
    hot = df.union(spark.range(3000).select(F.lit(1).cast("long").alias("id"), F.lit(1).cast("long").alias("x")))
    a, b = sampling.by_hash(hot, 300), sampling.by_hash(hot.repartition(7), 300)
    assert a.num_rows == 300 and a.equals(b) and len(set(a["id"].to_pylist())) == 300
    assert a.column_names == ["id", "x"]
    assert set(a["id"].to_pylist()) <= set(sampling.by_hash(hot, 400)["id"].to_pylist())


def test_few_rows_are_taken_whole(spark):
    df = spark.range(10)
    assert sorted(sampling.by_hash(df, 50)["id"].to_pylist()) == list(range(10))
    assert sampling.by_hash(df.limit(0), 50).num_rows == 0
