"""Run registered queries next to their SQL checks: `python -m assaymill.plans.check [sf_dir] [name ...]`."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else (0.0 if v == 0 else v)
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _plain(x)) for k, x in v.items()))
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(spark, sf, name, con):
    from assaymill.plans import catalog
    df = catalog.QUERIES[name](spark, sf)
    got_c, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in catalog.CHECKS:
        return f"rows only ({len(got)})", bool(got)
    res = con.execute(catalog.CHECKS[name])
    want_c, want = rows_of([d[0] for d in res.description], res.fetchall())
    if got_c != want_c:
        return f"columns differ: {got_c} / {want_c}", False
    if got == want:
        return f"ok ({len(got)} rows)", len(got) > 0
    only_got = [r for r in got if r not in set(want)][:2] if len(got) < 200000 else []
    only_want = [r for r in want if r not in set(got)][:2] if len(got) < 200000 else []
    return f"differ: {len(got)} / {len(want)} rows; {str(only_got)[:600]} / {str(only_want)[:600]}", False


def connect(sf):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf}/{t}.parquet"
        if os.path.exists(path) or glob.glob(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def main(argv):
    from pyspark.sql import SparkSession

    from assaymill import session
    from assaymill.plans import catalog
    sf = argv[0] if argv else "/root/testdata/sf0.01"
    spark = session.configure(SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
                              .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf), []
    wanted = argv[1:]
    for name in catalog.QUERIES:
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        t = time.time()
        try:
            text, ok = compare(spark, sf, name, con)
        except Exception as e:  # report and go on
            text, ok = f"{type(e).__name__}: {str(e)[:1500]}", False
        print(f"{'  ' if ok else '! '}{name:34s} {time.time() - t:6.2f}s  {text}", flush=True)
        if not ok:
            bad.append(name)
    print(f"{len(bad)} not ok: {bad}")
    return len(bad)


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
