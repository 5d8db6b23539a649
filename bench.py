"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) is the data, BENCH_CPUS (default 8)
other results are computed in full, every row and column, and dropped: results
as long as the input belong in a table, not in the driver.
"""

from __future__ import annotations

import json
import os
import time

from stockglass.plans.registry import QUERIES
from stockglass.session import local_session

HEADLINE = (
    "weekly_inventory_summary",
    "daily_fact",
    "last_inventory_of_week",
    "weekly_eow_levels",
    "dq_suite_inventory",
    "dq_suite_sales",
    "climate_sparse_attributes",
    "climate_year_load",
    "union_csv_by_name",
    "landing_completeness",
    "publish_archive",
)
COLLECTED = {"weekly_inventory_summary"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    conf = {"spark.driver.memory": "8g", "spark.sql.shuffle.partitions": cores}
    spark = local_session(cores, "bench", **conf)
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> None:
        result = QUERIES[name](spark, sf_dir)
        if name in COLLECTED:
            result.collect()
        else:
            result.write.format("noop").mode("overwrite").save()

    run("weekly_inventory_summary")  # start Python workers, load classes
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        run(name)
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
