"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and
BENCH_QUERIES (comma separated names, default the headline set) choose the run.
Each query is planned and fully executed into a no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from schedlytics.queries import load
from schedlytics.session import build_session

HEADLINE = [
    "scan_projected", "append_missing", "dense_week_index", "days_since_last", "area_membership", "nearest_cluster", "group_agg", "weekly_stats",
    "duplicate_flag", "restaurant_quartiles", "expanding_stats", "recency_weighted", "prepared_history", "panel_client", "panel_pair", "client_usage",
    "training_features", "lateness_features", "order_schedule_ratio", "client_routing", "schedule_input", "capacity_assign", "cluster_groups",
    "publish_rows", "rule_type_list", "rule_premium_share", "rule_report", "json_branch_docs",
    "scoring_candidates", "score_attach_branch", "hybrid_predictions", "clean_features", "relevance_share", "candidate_grid", "latest_lateness",
    "publish_replace", "prepared_history_until",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session("bench", cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    queries = load()
    run = lambda n: queries[n].run(spark, folder).write.format("noop").mode("overwrite").save()
    run("scan_parquet")
    times = {}
    for name in names:
        start = time.perf_counter()
        run(name)
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name:28s} {times[name]:8.3f}s", file=sys.stderr, flush=True)
    sf = Path(folder).name.removeprefix("sf")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))


if __name__ == "__main__":
    main()
