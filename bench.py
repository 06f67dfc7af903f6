"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs once to warm up and once timed; execution is forced with the
``noop`` sink, so results are fully computed but never pulled to the driver.
Prints one JSON line.
"""

from __future__ import annotations

import importlib.util
import json
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

HEADLINE = [
    "c1_tad_supplier_nation",        # flagship TAD
    "c1_assemble_tad_customer",
    "d9_pivot_count_many",
    "d15_describe_percentiles",
    "d18_olap_cube_grain",
    "e7_lookback_features",
    "e8_year_ago_window_mean",
    "e10_anchor_subwindow_features",
    "c8_interval_lookback_join",
    "b15_dense_row_id",
    "j10_sequential_iqr_filter",
    "k1_woe_iv_table",
    "k5_ks_two_sample",
    "m19_roc_curve",
    "o2_tfidf_ngrams",
    "h14_strip_html",
    "m12_knn_classifier_k_sweep",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from tadkit.session import get_spark
    spark = get_spark(f"local[{cpus}]", int(cpus), app="tadkit-bench",
                      extra={"spark.driver.memory": "20g"})
    spark.sparkContext.setLogLevel("ERROR")
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(HERE, "__spark_entry__.py"))
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    qs = entry.queries()
    names = [n for n in HEADLINE if n in qs]
    if len(sys.argv) > 1:
        names = [n for n in names if any(p in n for p in sys.argv[1:])]
    times = {}
    for name in names:
        best = None
        for _ in range(2):
            t0 = time.time()
            qs[name](spark, sf_dir).write.mode("overwrite").format("noop").save()
            best = time.time() - t0
        times[name] = round(best, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_warm", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))


if __name__ == "__main__":
    main()
