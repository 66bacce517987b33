"""Headline timings as one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (8) and BENCH_RUNS (5) set the data,
the cores and the number of warm runs per query, of which the median counts.
``daily_chain`` is one run of the whole chain, from the given tables to stored base returns, and
``daily_run`` one of the stored daily run with all result tables. ``panel_rows`` says how large the panel is.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from riskpanel.catalog.inputs import Inputs, inputs
from riskpanel.catalog.queries import queries
from riskpanel.session import local_session

HEADLINE = ("te_summary", "beta_summary", "var_covariance", "hierarchy_means", "complete_history", "risk_report")
CHAIN = ("panel", "calendar", "real", "completed", "base")


def timed(action) -> float:
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = local_session("bench", scratch=tempfile.mkdtemp(prefix="bench-"))
    registered = queries()

    def run(key: str) -> None:
        registered[key](spark, sf_dir).write.format("noop").mode("overwrite").save()

    def chain() -> None:
        fresh = Inputs(spark, sf_dir)
        for name in CHAIN:
            getattr(fresh, name)

    seconds = {}
    for key in HEADLINE:
        run(key)
        seconds[key] = statistics.median(timed(lambda: run(key)) for _ in range(runs))
    seconds["daily_chain"] = timed(chain)
    seconds["daily_run"] = timed(lambda: run("daily_run"))
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of median warm seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {key: round(value, 3) for key, value in seconds.items()},
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "panel_rows": inputs(spark, sf_dir).panel.count(),
                "cores": spark.sparkContext.defaultParallelism,
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
