"""Rates at millions of rows: raw files to silver, gold and report, uniform or skewed.

    python tools/scale_probe.py /tmp/probe --rows 10000000 --skew

The raw logs are made by Spark first (untimed). With --skew a third of all rows
share one computer and a third one second.
"""

import argparse
import json
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.operators.enrich import enrich_flows
from emberlog.plans.gold import build_gold
from emberlog.plans.report import validation_report
from emberlog.plans.silver import build_silver_iocs, build_silver_log
from emberlog.sources import read_silver

SECONDS = 200_000
COMPUTERS = 2_000


def made(column: int, values: int) -> str:
    return f"pmod(xxhash64(id, {column}), {values})"


def raw_logs(spark: SparkSession, rows: int, skew: bool) -> dict[str, DataFrame]:
    """Four logs in time order; a computer has four users of its own."""

    def hot(column: int, value: str, usual: str) -> str:
        return f"IF({made(column, 3)} = 0, {value}, {usual})" if skew else usual

    def log(column: int) -> DataFrame:
        return spark.range(0, rows, 1, 16).selectExpr(
            "id",
            hot(column, "4242", f"CAST(id * {SECONDS} / {rows} AS INT)") + " AS time",
            hot(column + 1, "7", made(column + 2, COMPUTERS)) + " AS n",
        )

    return {
        "auth": log(10).selectExpr("time", f"'U' || (4 * n + {made(13, 4)}) AS u", "'C' || n AS c"),
        "dns": log(20).selectExpr("time", "'C' || n AS c", f"'C' || {made(23, COMPUTERS)} AS d"),
        "flows": log(30).selectExpr(
            "time", f"{made(33, 60)} AS a", "'C' || n AS c", f"'N' || {made(34, 20000)} AS p",
            f"'h' || {made(35, 3000)} AS d", f"{made(36, 1024)} AS q", "6 AS r",
            f"{made(37, 50)} + 1 AS k", f"{made(38, 50000)} + 50 AS b",
        ),
        "proc": log(40).selectExpr(
            "time", f"'U' || {made(43, 9000)} || '@DOM1' AS u", "'C' || n AS c",
            f"'P' || {made(44, 300)} AS p", f"IF({made(45, 2)} = 0, 'Start', 'End') AS e",
        ),
    }


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("folder")
    parser.add_argument("--rows", type=int, default=10_000_000)
    parser.add_argument("--skew", action="store_true")
    parser.add_argument("--cpus", default="8")
    parser.add_argument("--memory", default="16g")
    parser.add_argument("--repeats", type=int, default=3, help="timed runs of each job, after one that isn't counted")
    args = parser.parse_args()
    spark = (
        SparkSession.builder.master(f"local[{args.cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", args.memory)
        .config("spark.sql.shuffle.partitions", "64")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{args.folder}/shared")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    bronze, silver, gold = (f"{args.folder}/{layer}" for layer in ("bronze", "silver", "gold"))
    for name, df in raw_logs(spark, args.rows, args.skew).items():
        codec = "bzip2" if name == "auth" else "gzip"
        df.write.mode("overwrite").csv(f"{bronze}/{name}", compression=codec)
    entry = F.expr("struct('http://h' || id * 5 || '/x' AS url, 'malware' AS threat)")
    spark.range(1000).agg(
        F.lit("ok").alias("query_status"), F.collect_list(entry).alias("urls")
    ).write.mode("overwrite").json(f"{bronze}/feed")

    result = {"rows_per_log": args.rows, "skew": args.skew, "cpus": args.cpus, "repeats": args.repeats}

    def timed(label: str, rows: int, work) -> None:
        work()
        runs = []
        for _ in range(args.repeats):
            start = time.perf_counter()
            work()
            runs.append(time.perf_counter() - start)
        seconds = sorted(runs)[len(runs) // 2]
        result[label] = {"sec": round(seconds, 1), "rows_per_sec": round(rows / seconds), "all_sec": [round(r, 1) for r in runs]}

    build_silver_iocs(spark, f"{bronze}/feed", silver)
    for name in ("auth", "dns", "flows", "proc"):
        timed(
            f"silver_{name}", args.rows,
            lambda: build_silver_log(spark, name, f"{bronze}/{name}", silver).count(),
        )
    tables = [read_silver(spark, silver, name) for name in ("flows", "auth", "proc", "iocs")]
    timed("gold_flows", args.rows, lambda: build_gold(spark, silver, gold))
    timed(
        "enriched_flows", args.rows,
        lambda: enrich_flows(*tables).write.format("noop").mode("overwrite").save(),
    )
    timed(
        "report", 4 * args.rows,
        lambda: [df.collect() for df in validation_report(spark, silver, gold).values()],
    )
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
