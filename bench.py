"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (data folder), BENCH_CPUS (local cores) and BENCH_QUERIES (comma
list) override the defaults.  Each query is run once to warm up the JVM and
twice for time; its whole result is computed and the better run counts.
"""

import json
import os
import re
import time

from checks.session import local_session
from checks.workload import queries

HEADLINE = [
    "clean_clicks",
    "edge_baselines",
    "referrer_distribution",
    "traffic_spikes",
    "spikes_prior_history",
    "mix_shifts_all_ties",
    "js_shift",
    "forecast_trend",
    "forecast_smoothing",
    "forecast_arima",
    "all_anomalies",
    "enriched_anomalies",
    "full_run",
    "structural_scores",
    "top_ten_referrers",
    "anomaly_details",
    "insights",
    "pagerank",
    "random_walks",
    "stream_window_counts",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    names = os.environ["BENCH_QUERIES"].split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    known, seconds = queries(), {}
    for name in names:
        runs = []
        for _ in range(3):
            start = time.perf_counter()
            known[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs[1:]), 3)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
