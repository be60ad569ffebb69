"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query is executed in full with the ``noop`` sink (every column computed,
nothing collected to the driver): once to warm up, then BENCH_RUNS (default 2) times, of
which the median counts.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from brieflow.plans.catalog import QUERIES  # noqa: E402
from brieflow.session import get_session  # noqa: E402

HEADLINE = [
    "a43_score",             # scoring projection (enrich + score)
    "a46_top_n_per_domain",  # top-N per domain
    "a22_simhash",           # fingerprints
    "a17_hamming_pairs",     # exact near-duplicate pairs (banded join)
    "a24_l2_near_dup",       # leader election (rounds)
    "a18_cosine_pairs",      # exact cosine pairs (block join)
    "a51_briefing",          # full pipeline
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = get_session(f"local[{cpus}]", shuffle_partitions=max(cpus, 4))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    times = {}
    for name in names:
        fn, _ = QUERIES[name]
        took = []
        for _ in range(runs + 1):  # the first run warms up: it loads classes and compiles the plan's code
            t0 = time.time()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            took.append(time.time() - t0)
        times[name] = round(median(took[1:]), 3)
        print(f"{name}: {times[name]}s (first run {took[0]:.3f}s)", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus}))


if __name__ == "__main__":
    main()
