"""Time the headline queries: one warm-up, then the median of several runs, as one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3),
BENCH_QUERIES (comma-separated names; ``all`` for every query).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from harborline.plans.catalog import all_queries  # noqa: E402
from harborline.session import build_session  # noqa: E402

HEADLINE = [
    "stg_ships_dedup",
    "weather_enriched",
    "latest_vehicle_state",
    "ship_eta_table",
    "fact_alerts",
    "air_recovery_options",
    "stock_context",
    "orders_coverage",
    "stock_horizon",
    "trade_centrality",
    "graph_hops",
    "graph_shortest_time",
    "graph_pagerank",
    "windowed_ship_metrics",
    "window_risk_class",
    "stream_ship_metrics",
    "graph_components",
    "ship_scenarios",
    "flight_verdict",
    "control_tower_kpis",
    "weekly_demand",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    catalog = all_queries()
    names = list(catalog) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE

    spark = build_session(
        "harborline-bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        # The no-op sink computes every column of every row and moves nothing to the driver.
        catalog[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    timings = {}
    for name in names:
        run(name)
        timings[name] = round(statistics.median(run(name) for _ in range(runs)), 4)
    print(json.dumps({
        "metric": "headline_queries_total_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
