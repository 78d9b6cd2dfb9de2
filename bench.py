"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

``python bench.py --all`` times every registered query, ``python bench.py name ...`` the named ones.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tideline.plans import QUERIES
from tideline.session import local_session

HEADLINE = [
    "province_order_window", "sku_order_window", "order_detail_retract", "order_detail_latest", "order_detail_fact",
    "payment_fact", "refund_fact", "cdc_by_table", "route_rules", "traffic_window", "home_detail_uv", "login_uu_back",
    "visitor_flag_repair", "keyword_window_documents", "keyword_freq", "interval_join_view_purchase",
    "user_cumulative_pv", "moderate_comments", "infer_age", "report_brand", "pivot_status", "unpivot_amounts",
    "dim_upsert", "preaggregate",
]


def seconds(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main(argv: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = list(QUERIES) if "--all" in argv else argv or HEADLINE
    spark = local_session(cores, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    seconds(spark, "province_order_window", sf_dir)  # warm up the JVM
    timings = {name: seconds(spark, name, sf_dir) for name in names}
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_seconds", "value": round(sum(timings.values()), 3), "unit": "sec", "queries": timings, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
