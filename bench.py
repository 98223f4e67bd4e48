"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each query is run to completion (full collect-free materialisation through a
``noop`` write), warm-up first, then the median of ``BENCH_RUNS`` timed runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from salesguard.plans.registry import QUERIES  # noqa: E402
from salesguard.session import build  # noqa: E402

HEADLINE = ["range_table", "attribution_report", "rolling_spikes", "daily_sales_store", "hierarchical_outliers",
            "net_invoice_sales", "isolation_forest", "kmeans_2d", "elliptic_envelope", "one_class_svm"]


def run(spark, name, sf_dir):
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build(f"local[{cpus}]", shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE", "16")))
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    out = {}
    for n in names:
        run(spark, n, sf_dir)                       # warm-up
        out[n] = round(statistics.median(run(spark, n, sf_dir) for _ in range(runs)), 3)
    total = round(sum(out.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_sec", "value": total, "unit": "sec", "queries": out,
                      "sf": float(sf) if sf.replace(".", "").isdigit() else sf, "cpus": int(cpus),
                      "input_lines": lines,
                      "range_pipeline_lines_per_sec": round(lines / out["range_table"], 1) if "range_table" in out
                      else None}))
    spark.stop()


if __name__ == "__main__":
    main()
