"""Time the headline queries and print one JSON line.

Every query is run to a no-op sink, so all rows and columns are computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from bidloom.plans.catalog import QUERIES
from bidloom.session import apply_settings

HEADLINE = [
    "bid_audit", "extract_all", "validate_all", "contracts_table", "bidders_table",
    "bidders_as_read", "bidders_summary", "bidders_item_c", "bidders_bid_tabs", "items_from_text", "items_from_table",
    "asof_next_total", "rank_fill", "classify", "rule_classify_text", "raw_text_tokens", "x_contract_number", "x_dates", "x_awarded_to",
    "assemble_text", "text_stats", "ocr_triage", "v_contract_totals", "v_bid_items_sum", "v_bidder_outliers", "v_dates", "v_goals",
    "upsert_contracts", "dedup_bidders", "incremental_changed", "state_merge", "fingerprint", "route_sources",
    "summary_by_type", "describe_time_by_type", "award_histogram", "bid_ranking", "stream_status_counts",
]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bidloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        # as many shuffle partitions as cores: merging them would leave cores idle in the regex stages
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_SHARED_DIR", "/tmp/bidloom-bench"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # call-site capture doubles the time to build large expressions
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return apply_settings(spark)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark.read.parquet(f"{sf_dir}/orders.parquet").count()  # start the executors
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total wall time of the headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
