"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR  folder with the tables   (default /root/testdata/sf0.1)
BENCH_CPUS    threads                  (default 8)
BENCH_RUNS    runs per query, of which the fastest counts (default 3)
"""

from __future__ import annotations

import json
import os
import re
import time

from quotidian.registry import QUERIES
from quotidian.session import local_session

HEADLINE = (
    "positions",
    "ohlcv_bars",
    "brand_bars",
    "curate_prices_all",
    "dq_report",
    "realized_vol",
    "price_features_asof",
    "price_features_panel",
    "price_features_gaps",
    "zscore_by_date",
    "signal_scores_with_fundamentals",
    "signal_scores_panel",
    "positions_panel",
    "sector_exposure",
    "yoy_growth",
    "filing_priority",
    "price_history",
    "vol_bands",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(
        cpus, "bench", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"}
    )
    # Untimed runs first, so that the first query does not pay for starting the engine.
    for name in ("available_sectors", "positions", "realized_vol"):
        QUERIES[name](spark, folder).collect()

    seconds = {}
    for name in HEADLINE:
        timings = []
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            timings.append(time.perf_counter() - start)
        seconds[name] = round(min(timings), 3)

    scale = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({
        "metric": "headline queries, total of the fastest runs",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale.group(1)) if scale else None,
    }))


if __name__ == "__main__":
    main()
