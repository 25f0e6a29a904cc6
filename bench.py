"""Time the headline reports on $BENCH_SF_DIR with local[$BENCH_CPUS]; one JSON line on stdout."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "I11_pareto", "I01_counter_delta", "I03_delta_restart", "I07_interpret_counters", "I10_wait_snapshot", "I12_wait_delta",
    "I13_wait_delta_view", "I15_rollup_avg", "I17_tier_policy", "I19_blocking_tree", "I20_blocked_over", "I30_top_statements",
    "I31_events_slow", "I32_events_blocking", "I33_events_deadlock", "I35_check_status", "I36_flapping", "I38_consecutive_failures",
    "I42_token_latency", "I44_current_latency", "I47_duration_histogram", "I55_capacity", "I67_blocked_count", "C11_asof_backward",
    "C14_interval_join", "C25_contains_join", "C26_longest_prefix", "C28_star_join", "D01_group_by", "D07_correlated_counts",
    "E01_global_row_number", "E06_surrogate_id", "E15_global_running_sum", "F02_top_k_ties", "G03_except", "H07_shred_xml",
    "H10_hierarchy", "H13_folder_rollup", "J01_interesting_unanswered", "J07_controversial_posts", "J15_duplicates_by_month",
    "J19_dangerous_tags", "J21_passive_reputation", "J30_duplicate_accounts", "K05_merge_full", "K14_enlarge", "Q01_reconcile_counts",
    "Q09_duplicate_definitions", "M03_stream_rollup", "M05_stream_delta",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("opskit-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    if "BENCH_CHECKPOINT_DIR" in os.environ:
        builder = builder.config("spark.checkpoint.dir", os.environ["BENCH_CHECKPOINT_DIR"])
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", ""):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="opskit-bench-"))

    from opskit.plans import catalog

    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else HEADLINE
    if names == ["all"]:
        names = list(catalog.QUERIES)
    catalog.QUERIES["D01_group_by"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    times = {}
    for name in names:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_reports_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
