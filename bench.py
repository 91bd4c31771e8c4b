"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8)
the local cores. Every query runs in full into a sink that discards rows; one
untimed round warms the JVM up and the better of two timed rounds counts.
"""

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from emberlog.registry.queries import LOG_VIEWS, QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "user_activity_summary",
    "enriched_flows",
    "join_flows_auth",
    "join_flows_proc",
    "join_flows_iocs",
    "gold_group",
    "dedup_auth",
    "dedup_proc",
    "dedup_iocs",
    "scan_auth",
    "scan_dns",
    "scan_flows",
    "scan_proc",
    "scan_threat_feed",
    "sink_gold_partitioned",
    "describe_gold",
    "null_rates",
    "ingest_totals",
    "sample_first_n",
    "sample_random_n",
    "job_silver",
]


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("emberlog-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="emberlog-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for name in HEADLINE:
        seconds(name)
    best = {name: round(min(seconds(name) for _ in range(2)), 3) for name in HEADLINE}
    flows = LOG_VIEWS["flows"](spark, SF_DIR).count()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(best.values()), 3),
                "unit": "sec",
                "queries": best,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "flows": flows,
                "flows_per_sec": round(flows / best["user_activity_summary"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
