"""Time the headline queries: one cold run, then the median of the warm runs; one JSON line out."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rowmill.queries import registry  # noqa: E402
from rowmill.session import build_session  # noqa: E402

QUERIES = (
    "band", "split_line", "castable_filter", "uniq_first", "uniq_dup", "uniq_tagged",
    "uniq_composite", "uniq_composite_dup", "uniq_nocase", "compliance_pass", "compliance_reject",
    "error_summary", "tests_summary", "test_unique", "test_relationships", "freshness",
    "lookup_unique", "fuzzy_lookup_lev", "fuzzy_lookup_jaccard", "update", "upsert",
    "insert_or_update", "update_written", "code_blocks", "join_blocks", "joined_text",
    "code_blocks_tagged", "scan", "scan_reject", "job_components", "flow_pass", "flow_reject",
    "flow_counts", "flow_written", "models_final",
)
WARM_RUNS = 3


def timed(query, spark, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cores}]", **{
        "spark.sql.shuffle.partitions": cores, "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or QUERIES
    runs = int(os.environ.get("BENCH_RUNS", WARM_RUNS))
    known, cold, warm = registry(), {}, {}
    for name in chosen:
        query = known[name][0]
        cold[name] = round(timed(query, spark, folder), 3)
        warm[name] = round(statistics.median(timed(query, spark, folder) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "headline_queries_warm_total", "value": round(sum(warm.values()), 3),
        "unit": "sec", "queries": warm, "cold": cold,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cores": cores,
        "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
