"""Time the headline queries: one JSON line on stdout.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
Results are consumed by the noop sink, so every row and column is computed.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "margin_pressure", "short_interest", "moving_averages", "technical_indicators", "trust_holding",
    "shareholding_concentration", "valuation_daily", "price_report_asof", "latest_quote_as_of_cohort",
    "rotation_trades", "top_n_sweep", "forward_return_panel", "feature_correlations", "eps_dataset", "strategy_cohort",
    "price_spikes", "completeness", "load_if_absent", "daily_quote_report", "statement_facts",
]


def main() -> None:
    from tickerloom.plans import QUERIES
    from tickerloom.session import get_session

    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench", f"local[{cpus}]",
        **{"spark.checkpoint.dir": os.environ.get("BENCH_CHECKPOINTS") or tempfile.mkdtemp(prefix="bench-"), "spark.driver.memory": "16g", "spark.sql.shuffle.partitions": cpus, "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["margin_pressure"](spark, sf).limit(1).collect()  # start the JVM and the Python workers
    names = sys.argv[1:] or HEADLINE
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
