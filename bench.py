"""Times the registered queries: prints one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the local cores, ``BENCH_QUERIES`` a
comma-separated choice of queries. Every query runs over whole tables and all its
rows are computed (``noop`` sink). Fits and searches that several queries state facts of are
made once, by the first of them. The forest's search runs only if it is named.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from workload.check import local_session  # noqa: E402
from workload.queries import QUERIES  # noqa: E402


#: Minutes long: 540 forests scored on ten folds.
ONLY_IF_NAMED = {"cv_grid_forest"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else [name for name in QUERIES if name not in ONLY_IF_NAMED]
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    # The first job starts the executors' code; it belongs to no query.
    QUERIES["group_count"].run(spark, sf_dir).collect()
    seconds: dict[str, float] = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total wall time of the registered queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
