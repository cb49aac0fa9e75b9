"""Time the registered queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables (default /root/testdata/sf0.1), ``BENCH_CPUS`` the cores.
The raw tables are landed and the star schema built first and timed on their own. Every
query then runs to its last row once to warm up and ``BENCH_RUNS`` times for the median;
one that takes longer than ``BENCH_LONG`` seconds is measured once.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from courtlake.plans.catalogue import QUERIES  # noqa: E402
from courtlake.schemas import RAW, STAR  # noqa: E402
from courtlake.session import builder  # noqa: E402
from courtlake.workspace import Workspace  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
LONG = float(os.environ.get("BENCH_LONG", "1.5"))
NAMES = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return time.perf_counter() - start


def main() -> None:
    spark = (
        builder("bench").master(f"local[{CPUS}]")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> None:
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()

    space = Workspace.of(spark, SF_DIR)
    load = {f"land_{name}": timed(lambda n=name: space.raw(n)) for name in RAW}
    load |= {f"load_{name}": timed(lambda n=name: space.warehouse(n)) for name in STAR}
    times = {}
    for name in NAMES:
        run(name)
        seconds = [timed(lambda: run(name))]
        while len(seconds) < RUNS and seconds[0] <= LONG:
            seconds.append(timed(lambda: run(name)))
        times[name] = round(statistics.median(seconds), 3)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "load": {name: round(seconds, 3) for name, seconds in load.items()},
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": CPUS,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
