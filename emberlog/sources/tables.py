"""Parquet tables of the silver and gold layers."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog import schemas


def read_silver(spark: SparkSession, root: str, name: str) -> DataFrame:
    schema = schemas.IOCS if name == "iocs" else schemas.LOGS[name]
    return spark.read.schema(schema).parquet(f"{root}/{name}")


def read_gold(
    spark: SparkSession,
    path: str | list[str],
    start: int | None = None,
    end: int | None = None,
) -> DataFrame:
    """The activity summary at one or several paths, optionally with
    `start <= time_bucket <= end`.

    The declared schema keeps `time_bucket` a long (directory names alone would
    be read as int), and the bare-column comparison prunes directories.
    """
    paths = [path] if isinstance(path, str) else path
    gold = reduce(
        DataFrame.unionByName,
        (spark.read.schema(schemas.GOLD).parquet(p).select(schemas.GOLD.fieldNames()) for p in paths),
    )
    if start is not None:
        gold = gold.where(F.col("time_bucket") >= start)
    if end is not None:
        gold = gold.where(F.col("time_bucket") <= end)
    return gold
