"""Print a one-line physical-plan summary (and optionally the formatted
plan) for registered queries: shuffles, aggregate and join strategies,
window limits, partition and pushed filters, read schemas, Python nodes.

Usage: python tools/explain_plans.py [sf_dir] [--full] [name ...]
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlens import registry  # noqa: E402
from ledgerlens.session import build_session  # noqa: E402

DEFAULT = ["kpis_daily", "top_merchants", "gold_events_daily", "dedup_event_id", "geoip_range_join",
           "v_geo_dashboard_latlon", "silver_scan_day", "dq_audit", "bronze_parse_typed"]
PATTERN = re.compile(
    r"(HashAggregate|SortAggregate|ObjectHashAggregate|Exchange [a-zA-Z]+|BroadcastHashJoin|"
    r"SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct|WindowGroupLimit|"
    r"Window|Expand|Union|Generate|TakeOrderedAndProject|InMemoryTableScan|\w*EvalPython\w*|"
    r"PartitionFilters: \[[^\]]*\]|PushedFilters: \[[^\]]*\]|ReadSchema: [^\n]{0,160})")


def main():
    args = [a for a in sys.argv[1:] if a != "--full"]
    full = "--full" in sys.argv
    sf = args[0] if args and "/" in args[0] else "/root/testdata/sf0.01"
    names = [a for a in args if "/" not in a] or DEFAULT
    spark = build_session("local[8]", shuffle_partitions=16,
                          extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="ledgerlens-explain-")})
    qs = registry.queries()
    for name in names:
        df = qs[name](spark, sf)
        df.write.format("noop").mode("overwrite").save()  # final adaptive plan
        plan = df._jdf.queryExecution().executedPlan().toString()
        seen = list(dict.fromkeys(PATTERN.findall(plan)))
        print(f"{name}: " + " | ".join(seen))
        if full:
            df.explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
