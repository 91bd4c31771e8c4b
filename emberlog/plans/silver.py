"""Bronze to silver: each raw file is read once, counts come from the written tables or the write itself."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog import schemas
from emberlog.operators.gate import Limits, write_checked
from emberlog.operators.sampling import leading_rows
from emberlog.operators.statistics import row_count
from emberlog.plans.together import run_together
from emberlog.sinks import write_iocs, write_silver
from emberlog.sources import read_flagged_log, read_log, read_silver, read_threat_feed
from emberlog.sources.feed import recent_iocs

PREVIEW_ROWS = 5


def build_silver_log(
    spark: SparkSession, name: str, source: str, root: str, partitions: int = 0
) -> DataFrame:
    """One raw log (auth, dns, flows or proc) as the silver table `root/name`."""
    write_silver(read_log(spark, source, schemas.LOGS[name]), f"{root}/{name}", partitions)
    return read_silver(spark, root, name)


def build_silver_logs(
    spark: SparkSession, sources: dict[str, str], root: str, partitions: int = 0
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """All raw logs as silver tables: (log, records, schema_matches) of each, and its first rows.

    The logs are written at the same time; an error of one ends all. Records and schema are
    those of the written files, so the raw files aren't read again.
    """
    jobs = {
        name: lambda name=name, source=source: build_silver_log(spark, name, source, root, partitions)
        for name, source in sources.items()
    }
    run_together(spark, jobs)
    return silver_report(spark, root, list(sources)), {
        name: leading_rows(read_silver(spark, root, name), PREVIEW_ROWS) for name in sources
    }


def build_checked_log(
    spark: SparkSession, name: str, source: str, root: str, limits: Limits = Limits(), partitions: int = 0
) -> dict[str, int]:
    """One raw log as the silver table `root/name`, if it keeps `limits`; what the write counted.

    The raw file is read once: records, malformed lines and nulls of every column are counted by
    the tasks that write. A breach raises an error and leaves the old table in place.
    """
    return write_checked(read_flagged_log(spark, source, schemas.LOGS[name]), f"{root}/{name}", limits, partitions)


def build_checked_logs(
    spark: SparkSession, sources: dict[str, str], root: str, limits: dict[str, Limits], partitions: int = 0
) -> DataFrame:
    """All raw logs, each under its limits (none by default), at the same time.

    Returns (log, column, records, malformed, nulls), one row for each column of each log.
    """
    jobs = {
        name: lambda name=name, source=source: build_checked_log(
            spark, name, source, root, limits.get(name, Limits()), partitions
        )
        for name, source in sources.items()
    }
    rows = [
        (name, column, counts["records"], counts["malformed"], counts[f"nulls_{column}"])
        for name, counts in run_together(spark, jobs).items()
        for column in schemas.LOGS[name].fieldNames()
    ]
    return spark.createDataFrame(rows, "log string, column string, records long, malformed long, nulls long")


def silver_report(spark: SparkSession, root: str, names: list[str]) -> DataFrame:
    rows = []
    for name in names:
        stored = spark.read.parquet(f"{root}/{name}")
        have = [(f.name, f.dataType) for f in stored.schema.fields]
        matches = have == [(f.name, f.dataType) for f in schemas.LOGS[name].fields]
        rows.append(row_count(stored).select(F.lit(name).alias("log"), "records", F.lit(matches).alias("schema_matches")))
    return reduce(DataFrame.unionByName, rows)


def build_silver_iocs(
    spark: SparkSession, source: str, root: str, newest: int | None = None, on_bad: str = "fail"
) -> DataFrame:
    """The threat feed as `root/iocs`; `newest` keeps only that many recent entries.

    A document that is broken or not `ok` ends the job unless `on_bad="drop"`.
    """
    iocs = read_threat_feed(spark, source, on_bad)
    if newest is not None:
        iocs = recent_iocs(iocs, newest)
    write_iocs(iocs, f"{root}/iocs")
    return read_silver(spark, root, "iocs")
