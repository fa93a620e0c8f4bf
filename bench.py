"""Seconds per query; prints one JSON line.

Every query's result is written to Spark's ``noop`` sink, so that all columns of
all rows are computed. BENCH_SF_DIR names the tables, BENCH_CPUS the cores,
BENCH_QUERIES (comma separated) the queries; all of them otherwise. ``value`` is
the sum of the headline queries, the same in every round; ``all`` that of all.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from usageledger.queries import QUERIES  # noqa: E402
from usageledger.session import local_session  # noqa: E402

HEADLINE = (
    "business_key",
    "merge_insert_only",
    "merge_upsert",
    "metering_history",
    "scope_rows_either",
    "scope_rows_both",
    "rate_timeseries_all",
    "convert_credits_to_currency",
    "attribute_credits",
    "snapshot_diff",
    "top_recent",
    "rpt_auto_clustering",
    "rpt_copy_history",
    "rpt_db_storage",
    "rpt_query_history",
    "rpt_sessions",
    "rpt_task_history",
    "rpt_warehouse_credit",
    "rpt_org_currency",
    "rpt_org_metering",
    "rpt_query_credit",
    "rpt_db_schema_credit",
    "rpt_month_credits_pivot",
    "rpt_table_storage",
    "rpt_object_dependencies",
    "warehouse_daily_credits_merge",
    "workspace_monthly_budget",
    "bu_warehouse_spend",
    "tag_override_database",
    "grants_to_patterns",
    "access_map_reconcile",
    "stream_incremental_append",
    "stream_dedup_late",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    asked = os.environ.get("BENCH_QUERIES", "")
    names = [q for q in asked.split(",") if q] or [*HEADLINE, *(q for q in QUERIES if q not in HEADLINE)]
    spark = local_session(cores)

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("rpt_db_schema_credit")  # starts the JVM's compilers and file caches
    seconds = {name: round(run(name), 3) for name in names}
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "usage_mart_total_seconds",
                "value": round(sum(s for q, s in seconds.items() if q in HEADLINE), 3),
                "unit": "sec",
                "all": round(sum(seconds.values()), 3),
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
