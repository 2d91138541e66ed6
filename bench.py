"""Headline queries at one scale factor; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "readout_ranking", "best_value_per_protocol_gene", "expression_matrix_wide", "rank_pct_norm", "quantile_norm",
    "readout_timepoints", "day_to_stage", "tier1_mapping", "stage_matrix", "upsert_coalesce", "cache_longest",
    "reference_resolution", "topo_levels", "mine_accessions", "ground_terms", "budget_fold", "xml_full_text",
    "series_matrix", "soft_records", "audit_sample", "export_stage_expression", "xml_references", "xml_accessions", "best_probe",
    "supplement_fold", "processing_order", "export_stage_expression_wide", "readout_summary",
]


def main() -> None:
    from pyspark.sql import SparkSession

    from assaymill import session
    from assaymill.plans import catalog

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = session.configure(
        SparkSession.builder.master(f"local[{cpus}]").appName("bench").config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "16g")).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    times = {}
    for name in names:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "total_wall_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
