"""Time the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line.

The driver tables are first landed as form files, as a connector would leave them (timed apart as
``landing``). Every reporting table is then built from the landed files, and some operators run on the
driver tables themselves. A query is built, planned and run into a discarding sink; its value is the
median of $BENCH_RUNS runs (default 2) after one warm-up. ``python bench.py name ...`` limits the run.
"""

from __future__ import annotations

import dataclasses
import json
import os
import statistics
import sys
import tempfile
import time

from fieldtally.driver import QUERIES
from fieldtally.driver.raw_forms import LANDED, inputs
from fieldtally.forms import FORMS
from fieldtally.plans.warehouse import TABLES, Inputs, Warehouse
from fieldtally.session import local_session
from fieldtally.sources import land_form, read_form

OPERATORS = (
    "admin_lookup", "attach_parent", "attach_children", "campaign_window", "dose_join", "latest_per_key",
    "attach_latest", "grouped_sum", "pivot_sums", "aggregate_join_back", "category_proportion",
)


def land(spark, sf_dir: str) -> tuple[Inputs, float]:
    start = time.perf_counter()
    folder = tempfile.mkdtemp(prefix="bench-", dir=os.environ.get("BENCH_TMP", "/tmp"))
    for name, form in LANDED.items():
        land_form(form(spark, sf_dir), f"{folder}/{name}")
    spread = spark.sparkContext.defaultParallelism
    forms = {name: read_form(spark, FORMS[name], f"{folder}/{name}", spread=spread) for name in LANDED}
    return dataclasses.replace(inputs(spark, sf_dir), forms=forms), time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench")
    landed, landing = land(spark, sf_dir)

    staged = [t.name for t in TABLES if t.name.startswith("staging.")]
    timed = {name.split(".")[1]: lambda name=name: Warehouse(landed)[name] for name in staged}
    timed |= {name: lambda name=name: QUERIES[name](spark, sf_dir) for name in OPERATORS}
    seconds = {}
    for name in sys.argv[1:] or timed:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            timed[name]().write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "landing": round(landing, 3),
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
