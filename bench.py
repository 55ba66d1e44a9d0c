"""Time the library's own queries: one JSON line on standard output.

`BENCH_SF_DIR` names the tables, `BENCH_CPUS` the number of local cores. Each query is run once to
warm up and then `BENCH_RUNS` times; the smallest time counts. Results are computed in full but
written nowhere.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from windflow.plans import stream_catalog  # noqa: E402, F401  registers its queries
from windflow.plans.catalog import QUERIES  # noqa: E402
from windflow.session import build_session  # noqa: E402

HEADLINE = sorted(QUERIES)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    width = cpus if cpus.isdigit() else "8"
    spark = build_session("windflow-bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": width, "spark.ui.enabled": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g")})
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    seconds = {}
    for name in HEADLINE:
        if name.startswith("stream_"):  # a run of a job starts anew each time
            seconds[name] = round(timed(name), 4)
            continue
        timed(name)
        seconds[name] = round(min(timed(name) for _ in range(runs)), 4)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({"metric": "total time of the headline queries", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": float(scale.group(1)) if scale else folder}))
    spark.stop()


if __name__ == "__main__":
    main()
