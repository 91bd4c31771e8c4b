"""The whole batch: raw files to report. Every stage can be left out and later stages
then work on the tables already stored."""

from pyspark.sql import DataFrame, SparkSession

from emberlog.plans.gold import build_gold
from emberlog.plans.report import validation_report
from emberlog.plans.silver import build_silver_iocs, build_silver_logs

STAGES = ("iocs", "silver", "gold", "validate")


def run_batch(
    spark: SparkSession,
    sources: dict[str, str],
    silver_root: str,
    gold_root: str,
    stages: tuple[str, ...] = STAGES,
    partitions: int = 0,
) -> dict[str, DataFrame]:
    """Run the chosen stages in order and return the report sections.

    `sources` maps auth, dns, flows, proc and iocs to raw paths. An error of a
    stage ends the run.
    """
    unknown = set(stages) - set(STAGES)
    if unknown:
        raise ValueError(f"unknown stages: {sorted(unknown)}")
    report: dict[str, DataFrame] = {}
    if "iocs" in stages:
        build_silver_iocs(spark, sources["iocs"], silver_root)
    if "silver" in stages:
        logs = {name: sources[name] for name in ("auth", "dns", "flows", "proc")}
        report["silver"], _ = build_silver_logs(spark, logs, silver_root, partitions)
    if "gold" in stages:
        build_gold(spark, silver_root, gold_root)
    if "validate" in stages:
        report |= validation_report(spark, silver_root, gold_root)
    return report
