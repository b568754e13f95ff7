"""Times the headline queries and prints one JSON line.

`BENCH_SF_DIR` names the table folder and `BENCH_CPUS` the number of cores.
Every query runs once to warm up; the median of the next three runs counts.
A run includes building the frame, as some queries write a table while they do,
and computes all of its rows and columns without collecting them.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from hitledger.registry import QUERIES
from hitledger.session import build_session
from hitledger.sources import scratch

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3


def main() -> None:
    spark = build_session(
        "hitledger-bench",
        master=f"local[{CPUS}]",
        settings={
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="hitledger-warehouse-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    medians = {}
    for name, query in QUERIES.items():
        times = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        medians[name] = round(statistics.median(times[1:]), 4)
    scratch.clear(spark)
    spark.stop()
    line = {
        "metric": "total_query_time",
        "value": round(sum(medians.values()), 3),
        "unit": "sec",
        "queries": medians,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
