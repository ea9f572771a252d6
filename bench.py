"""Benchmark: every registered query over the landed fixture tables.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

The fixture tables are derived from the parquet in ``BENCH_SF_DIR`` and
landed once (``land_fixtures_sec``); then each pipeline job publishes its
stage once — lake catalog, graph, search documents, postings
(``stage_build_sec``).  Neither is part of the total.  Each query then runs
its own operator over its input stage into Spark's ``noop`` sink; a
query's time is the median of ``BENCH_RUNS`` runs (default 3).  Prints one
JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from metaweave.plans.queries import QUERIES, stages  # noqa: E402
from metaweave.session import get_session  # noqa: E402
from metaweave.sources.fixtures import landed_fixtures  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    scratch = tempfile.mkdtemp(prefix="mw-bench-")
    spark = get_session(
        f"local[{cpus}]",
        app_name="metaweave-bench",
        shuffle_partitions=cpus,
        conf={
            "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
            "spark.checkpoint.dir": f"{scratch}/checkpoints",
            "spark.sql.warehouse.dir": f"{scratch}/warehouse",
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": scratch,
        },
    )
    t0 = time.perf_counter()
    landed_fixtures(spark, sf_dir).all_raw()
    land = time.perf_counter() - t0
    t0 = time.perf_counter()
    stages(spark, sf_dir).build_all()
    stage_build = time.perf_counter() - t0

    times: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name, query in QUERIES.items():
        if only and name not in only:
            continue
        samples = []
        try:
            for _ in range(runs):
                t0 = time.perf_counter()
                query(spark, sf_dir).write.format("noop").mode("overwrite").save()
                samples.append(time.perf_counter() - t0)
        except Exception as e:  # noqa: BLE001 - report and go on with the other queries
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
            continue
        times[name] = round(statistics.median(samples), 3)
    spark.stop()
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "land_fixtures_sec": round(land, 3),
        "stage_build_sec": round(stage_build, 3),
        "runs": runs,
        "cpus": cpus,
        "failed": failed,
    }))


if __name__ == "__main__":
    main()
