"""Time the headline jobs on local cores: prints one JSON line.

Every job is run into a sink that reads all rows and keeps none, once to warm up and then a few times; the
median counts. Set BENCH_STREAMS=1 to time the streaming forms once as well.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import CATALOG  # noqa: E402
from millrace import build_session  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))

HEADLINE = [name for name in CATALOG if name.startswith("q") and not name.startswith(("q22_", "q23_"))]


def timed(spark, name: str) -> float:
    began = time.perf_counter()
    CATALOG[name].run(spark, FOLDER).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    conf = {"spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g")}
    spark = build_session("bench", f"local[{CPUS}]", **conf)
    spark.sparkContext.setLogLevel("OFF")
    seconds = {}
    for name in HEADLINE:
        timed(spark, name)
        seconds[name] = round(statistics.median(timed(spark, name) for _ in range(REPEATS)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    result = {
        "metric": "total_job_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
        "cpus": int(CPUS),
    }
    if os.environ.get("BENCH_STREAMS"):
        result["streams"] = {n: round(timed(spark, n), 3) for n in CATALOG if n.startswith("stream_")}
    print(json.dumps(result), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
