"""Headline-query bench.

Runs the headline queries at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] and prints one JSON line. Each query is forced to completion with the
``noop`` sink (full evaluation, no driver collect); the reported time per query is the
median of $BENCH_RUNS runs after one warm-up run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "did_estimate",          # events -> market-day panel -> difference-in-differences
    "lineitem_did",          # lineitem + orders -> market x ship-day panel -> DiD
    "decision_metrics",      # whole chain: listings, demand panel, campaign panel, estimate
    "opportunity_scores",    # per-market features, ranks, margin split
    "demand_panel",          # listings -> clean -> outlier filter -> rollup -> sub-market x day
    "scenario_panel",        # demand panel -> market-day rollup -> scenario funnel
    "report_lift",           # SQL report over warehouse views
    "rubric_score",          # evidence rubric over the whole document texts
    "null_profile_documents",
    "knn_classify",          # exact blocked k-NN on embeddings
    "roc_auc",
    "onehot",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    os.environ["BENCH_CPUS"] = cpus

    from liftkit.operators import profile
    from liftkit.plans.registry import QUERIES
    from liftkit.session import get_spark
    from liftkit.sources import tables as T

    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    queries = dict(QUERIES)
    queries["null_profile_documents"] = lambda s, d: profile.null_profile(T.read_table(s, d, "documents"))

    timings = {}
    for name in HEADLINE:
        fn = queries[name]

        def once():
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        once()  # warm-up: JIT, file listing, Python workers
        timings[name] = round(statistics.median(once() for _ in range(runs)), 3)

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total_median_wall",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": int(cpus),
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
