"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "flagship_dedup_by_source",
    "risk_severity_matrix",
    "dominant_severity",
    "upsert_by_key",
    "preprocess_words",
    "clean_text",
    "top_phrases",
    "cosine_pairs",
    "dedup_greedy",
    "nearest",
    "jaccard_pairs_exact",
    "dedup_minhash",
    "extract_title",
    "classify_severity",
    "k_metrics",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    from tidewater.session import build_session
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2), app="tidewater-bench")
    from tidewater.plans.registry import load_all
    reg = load_all()
    spark.range(1000).selectExpr("sum(id)").collect()  # session start-up, not a query
    times = {}
    for name in names:
        t0 = time.time()
        reg[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    print(json.dumps({"metric": "total_headline_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus}))


if __name__ == "__main__":
    main()
