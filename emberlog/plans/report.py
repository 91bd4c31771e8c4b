"""Validation report over stored silver and gold tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog import schemas
from emberlog.operators.quality import check_gold, null_rates, profile
from emberlog.operators.sampling import leading_rows
from emberlog.operators.statistics import (
    describe_numeric,
    distinct_entities,
    hit_rows,
    ingest_totals,
    reduction_pct,
)
from emberlog.plans.gold import GOLD_NAME
from emberlog.sources import read_gold, read_silver

SILVER = ["auth", "dns", "flows", "proc", "iocs"]


def validation_report(spark: SparkSession, silver_root: str, gold_root: str) -> dict[str, DataFrame]:
    """One small table per section of the report. Sections over missing tables are left out.

    `overall` is false if any table is missing or empty. Previews are whatever rows come
    first in the first files.
    """
    gold_path = f"{gold_root}/{GOLD_NAME}"
    paths = {name: f"{silver_root}/{name}" for name in SILVER} | {"gold": gold_path}
    sections = {"profile": profile(spark, paths)}
    status = {row["dataset"]: row["status"] for row in sections["profile"].collect()}
    sections["overall"] = sections["profile"].agg(F.bool_and(F.col("status") == "OK").alias("ok"))
    present = [name for name in SILVER if status[name] != "MISSING"]
    silver = {name: read_silver(spark, silver_root, name) for name in present}
    if silver:
        sections["ingest_totals"] = ingest_totals(silver)
    if "auth" in silver:
        sections["auth_preview"] = leading_rows(silver["auth"], 5)
        sections["auth_null_rates"] = null_rates(silver["auth"])
    if status["gold"] != "MISSING":
        gold = read_gold(spark, gold_path)
        sections["gold_preview"] = leading_rows(gold, 5)
        sections["gold_statistics"] = describe_numeric(gold.select(*schemas.GOLD_MEASURES))
        sections["gold_hit_rows"] = hit_rows(gold)
        sections["gold_entities"] = distinct_entities(gold)
        sections["gold_checks"] = check_gold(gold)
        if silver:
            raw = sections["ingest_totals"].where("dataset = 'TOTAL'")
            sections["reduction"] = reduction_pct(raw, gold)
    return sections
