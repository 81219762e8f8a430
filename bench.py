"""Benchmark the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints ONE JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}

Each query is executed in full with the ``noop`` sink (every row produced,
nothing collected to the driver).  Each query first runs once untimed (JIT
and codegen warm-up); the reported value is the median of ``$BENCH_REPEAT``
timed runs (default 3).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlens import registry  # noqa: E402
from ledgerlens.session import build_session  # noqa: E402

HEADLINE = [
    "kpis_daily",            # adapter -> DQ -> silver -> gold aggregate
    "gold_events_daily",     # wide mart with count distinct
    "top_merchants",         # aggregate + partial/final WindowGroupLimit
    "hourly",
    "dq_audit",              # validation + audit aggregate
    "dq_good_rows",          # row-level validated silver
    "dedup_event_id",        # keep-latest by key (partial max)
    "geoip_range_join",      # binned range join, row level
    "geo_daily_keep_unknown",
    "v_geo_dashboard_latlon",
    "bronze_parse_typed",    # to_json -> unglue -> from_json
    "silver_write_readback", # gzip bronze write + scan + validate + 3 writes
    "gold_write_readback",   # + silver_to_gold over all marts
    "stream_validate",       # Structured Streaming availableNow
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    ckpt = tempfile.mkdtemp(prefix="ledgerlens-bench-")
    spark = build_session(f"local[{cpus}]", app_name="ledgerlens-bench", shuffle_partitions=int(cpus) * 2,
                          extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "8g",
                                 # the tables are single row groups: deal them over all cores
                                 "spark.ledgerlens.inputPartitions": cpus})
    qs = registry.queries()
    names = only or HEADLINE
    qs["events_count"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    timings = {}
    for name in names:
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        runs = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(runs), 3)
    spark.stop()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total_median_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
        "repeat": repeat,
    }))


if __name__ == "__main__":
    main()
