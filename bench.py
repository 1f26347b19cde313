"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import tempfile
import time

from queries.catalog import QUERIES
from shelfpulse.session import get_session

HEADLINES = (
    "growth_weekly",
    "growth_yoy",
    "ltgr",
    "stock_turnover",
    "exposure_uplift",
    "repurchase_index",
    "price_matrix",
    "list_growth",
    "list_repurchase",
    "list_ranking",
    "placement_list",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    spark = get_session(
        "shelfpulse-bench",
        master=f"local[{cpus}]",
        **{
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "7g"),
            "spark.checkpoint.dir": os.environ.get("BENCH_STAGING") or tempfile.mkdtemp(),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["list_ranking"](spark, sf_dir).collect()  # warm-up
    seconds = {}
    for name in HEADLINES:
        times = []
        for _ in range(repeats):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(sorted(times)[len(times) // 2], 3)
    spark.stop()
    report = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main()
