"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from shopstrata.checks.queries import QUERIES
from shopstrata.session import local_session

HEADLINE = [
    "state_new_visitor",
    "state_unique_visit",
    "state_user_jump",
    "dwd_log_topics",
    "dwd_db_route",
    "sink_dim_upsert",
    "sink_dim_fold",
    "dwm_order_wide",
    "dwm_payment_wide",
    "dwm_order_wide_shuffled",
    "dwm_payment_wide_shuffled",
    "join_dim_user_shuffled",
    "dws_visitor",
    "dws_product",
    "dws_province",
    "dws_keyword",
    "udtf_tokenize",
    "agg_distinct_orders",
    "ads_gmv_day",
    "ads_gmv_trademark",
]
RUNS = 3


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS") or str(os.cpu_count() or 8)
    # Without the call sites that error messages would show, plans are built faster.
    spark = local_session(cores, "bench", **{"spark.sql.dataFrameQueryContext.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        times = []
        for _ in range(RUNS):
            started = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(min(times), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
