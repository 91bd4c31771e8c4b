"""Silver to gold."""

from pyspark.sql import DataFrame, SparkSession

from emberlog.operators.summary import user_activity_summary
from emberlog.sinks import write_gold
from emberlog.sources import read_gold, read_silver

GOLD_NAME = "user_activity_summary"


def build_gold(spark: SparkSession, silver_root: str, gold_root: str) -> DataFrame:
    """Write the activity summary of the silver tables and return the stored table."""
    tables = [read_silver(spark, silver_root, name) for name in ("flows", "auth", "proc", "iocs")]
    path = f"{gold_root}/{GOLD_NAME}"
    write_gold(user_activity_summary(*tables), path)
    return read_gold(spark, path)
