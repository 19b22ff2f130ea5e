"""Time the headline queries and print one JSON line.

Each query is run once; its result goes to the no-op sink, so every row is computed and nothing is
collected.  BENCH_SF_DIR and BENCH_CPUS choose the data and the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tidemark import build_session
from tidemark.plans import registry


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or list(registry.QUERIES)
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        int(cpus) if cpus.isdigit() else 8,
        {
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start-up of the session and its first read is not part of any query.
    registry.QUERIES["rows_by_run"].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        started = time.perf_counter()
        registry.QUERIES[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
