"""Readers of lines whose files share keys or compress well: tasks stay bounded, results do not change."""

from pyspark.sql import functions as F

from assaymill import session
from assaymill.functions import genes, numbers
from assaymill.operators import retrieval
from assaymill.plans import source_queries
from assaymill.sources import files, matrix, tables


def lined(spark, texts):
    return files.split_lines(spark.createDataFrame(list(texts.items()), "path string, content string"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tasks_grow_with_the_rows(spark):
    dealt = session.spread(spark.range(1000).withColumn("k", F.col("id") % 100), "k", 100)
    assert dealt.count() == 1000 and dealt.rdd.getNumPartitions() == 10
    assert session.spread(spark.range(0), "id").count() == 0


def test_lines_of_orders_are_dealt_by_their_number(spark, tmp_path):
    rows = spark.range(600_000).selectExpr("id div 4 AS l_orderkey", "CAST(id % 4 AS INT) AS l_linenumber", "CAST(1 AS DOUBLE) AS l_quantity",
                                           "CAST(2 AS DOUBLE) AS l_extendedprice")
    rows.write.parquet(str(tmp_path / "lineitem.parquet"))
    titles = source_queries.series_matrix_titles(spark, str(tmp_path))
    assert plan(titles).count("Exchange") == 2 and titles.rdd.getNumPartitions() == 3
    assert titles.count() == 450_000


def test_names_in_cells_mean_what_they_mean_alone(spark):
    names = ["ALB", " alb\t", "oct4", "ENSG00000101076.3", "ALB_chr4", "_CHR:ALB", "_chr:alb", "3172", "p1", "", None, "ENSGX", "x_CHR1", "albumin"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    keys = [k for k, _ in genes.lookup_rows()]
    got = df.select("n", genes.is_target_gene(F.col("n")).alias("one"), genes.any_target_gene(F.array(F.lit("x"), "n")).alias("any"),
                    genes.lookup_key(F.col("n")).isin(keys).alias("want")).collect()
    assert all(r["one"] == r["want"] and r["any"] == bool(r["want"]) for r in got), got
    assert {r["n"] for r in got if r["one"]} >= {"ALB", " alb\t", "oct4", "ENSG00000101076.3", "ALB_chr4", "albumin"}


def test_unquoted_cells(spark):
    texts = ['"a"', ' ""a b"" ', '"', '""', "", 'a"b', '"a" ', '"a"\u0085', '" ', "\t'x'\n", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(numbers.unquote(F.col("t")).alias("one"), F.get(numbers.unquote_all(F.array("t")), F.lit(0)).alias("many"),
                    F.regexp_replace(genes.strip(F.col("t")), r'^"+|"+$', "").alias("want")).collect()
    assert all(r["one"] == r["many"] == r["want"] for r in got), got


SERIES = '!Series_platform_id\t"GPL1"\n\n"ID_REF"\t"G1"\t"G2"\n"p1"\t1\t2\n"p2"\t3\t4\n\n"p1"\t9\t9\n'


def test_probes_meet_rows_without_a_shuffle_by_probe(spark):
    lines = lined(spark, {f"f{i}": SERIES for i in range(20)})
    probes = spark.createDataFrame([("GPL1", "p1", "ALB"), ("GPL1", "p2", "ALB")], "platform string, probe string, gene_symbol string")
    series = matrix.tables(lines, probes)
    rows = matrix.probe_rows(series, probes)
    assert "hashpartitioning(platform" not in plan(rows)
    best = matrix.cells(retrieval.best_probe(rows)).collect()
    assert {(r["file"], r["probe"], r["sample"], r["value"]) for r in best} == {
        (f"f{i}", "p2", s, v) for i in range(20) for s, v in (("G1", 3.0), ("G2", 4.0))}
    assert series.frames.where("end IS NOT NULL").count() == 20


def test_a_few_wide_files_are_not_shuffled_by_path(spark):
    wide = tables.wide_cells(lined(spark, {"a": "k\tx\ty\n1\t2\t3\nk\tx\ty\n2\t\t5\t6\n", "b": "y\tk\n7\t1\n"}), ["k"])
    assert "BroadcastHashJoin" in plan(wide) and "SortMergeJoin" not in plan(wide)
    assert {tuple(r) for r in wide.collect()} == {("a", "1", "x", 2.0), ("a", "1", "y", 3.0), ("a", "2", "x", None), ("a", "2", "y", 5.0), ("b", "1", "y", 7.0)}
    piped = tables.wide_cells(lined(spark, {"a": "k|x\n1|2\n"}), ["k"], "|")
    assert [tuple(r) for r in piped.collect()] == [("a", "1", "x", 2.0)]


def test_profiles_cut_no_further_than_they_look(spark):
    texts = {"t": "Gene\ta;b\nALB\t1\tx\nno tab; here, or there\n", "s": 'g;"a;b";c,d\nALB;x;1\nFOO;2;2\n', "c": 'n,gene,"s 1, a"\nrow,ALB,1\n,"oct4",2\n', "o": "ALB\nAFP\n"}
    found = {r["path"]: r for r in tables.profiles(lined(spark, texts)).collect()}
    assert {p: (r["delimiter"], r["header"], r["n_rows"]) for p, r in found.items()} == {
        "t": ("\t", ["Gene", "a;b"], 2), "s": (";", ["g", "a;b", "c,d"], 2), "c": (",", ["n", "gene", "s 1, a"], 2), "o": ("\t", ["ALB"], 1)}
    assert {p: (r["odd"], r["filled"], r["symbol"]) for p, r in found.items()} == {"t": (0, 2, 1), "s": (1, 2, 2), "c": (2, 1, 0), "o": (0, 1, 1)}
    lines = lined(spark, texts)
    rows = tables.panel_rows(lines, tables.profiles(lines)).collect()
    assert {(r["path"], tuple(r["cells"])) for r in rows} == {
        ("t", ("ALB", "1", "x")), ("s", ("ALB", "x", "1")), ("c", ("row", "ALB", "1")), ("c", ("", "oct4", "2")), ("o", ("AFP",))}
