"""Data-quality checks. Each returns a small table of findings."""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlog.functions.columns import BUCKET_SECONDS
from emberlog.operators.statistics import row_count

PROFILE_COLUMNS = "dataset string, files long, records long, size_mb double, status string"


def profile(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Files, records, size and status (OK, EMPTY, MISSING) of Parquet datasets.

    File sizes come from the listing and record counts from the file footers: no
    column is read. Works on every file system Spark reads.
    """
    rows = [_profile_one(spark, name, path) for name, path in paths.items()]
    return spark.createDataFrame(rows, PROFILE_COLUMNS)


def _profile_one(spark: SparkSession, name: str, path: str) -> tuple:
    try:
        listing = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.parquet")
            .load(path)
        )
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return name, None, None, None, "MISSING"
        raise
    found = listing.agg(F.count("*").alias("files"), F.sum("length").alias("bytes")).first()
    # Counting needs no column, so any schema will do, also for a folder without files.
    records = row_count(spark.read.schema("unread int").parquet(path)).first()["records"]
    size_mb = (found["bytes"] or 0) / 1_048_576
    return name, found["files"], records, size_mb, "OK" if records > 0 else "EMPTY"


def _as_rows(one_row: DataFrame, label: str, value: str) -> DataFrame:
    """A one-row aggregate turned into (label, value) rows."""
    cells = [
        F.struct(F.lit(name).alias(label), F.col(f"`{name}`").alias(value))
        for name in one_row.columns
    ]
    return one_row.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def null_rates(df: DataFrame) -> DataFrame:
    """Share of NULLs in each column (NULL for an empty table), in one pass."""
    rates = [F.avg(F.col(f"`{c}`").isNull().cast("int")).alias(c) for c in df.columns]
    return _as_rows(df.agg(*rates), "column", "null_rate")


def gold_rules(width: int = BUCKET_SECONDS) -> dict[str, Column]:
    return {
        "total_flows >= 1": F.col("total_flows") >= 1,
        "total_bytes >= total_packets": F.col("total_bytes") >= F.col("total_packets"),
        "time_bucket on the hour": F.col("time_bucket") % width == 0,
        "malicious_hits >= 0": F.col("malicious_hits") >= 0,
    }


def check_gold(gold: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """Violations of each rule; a rule over a NULL is not violated."""
    rules = rules or gold_rules()
    return _as_rows(
        gold.agg(*(F.count_if(~rule).alias(name) for name, rule in rules.items())),
        "rule",
        "violations",
    )


def check_fanout(flows: DataFrame, enriched: DataFrame) -> DataFrame:
    """Rows before and after the joins, which must be equal.

    The enriched rows are counted in two parts by a hash over all their columns. The
    optimizer can't answer that without the joined payloads, so the joins really run.
    """
    whole = F.xxhash64(*(F.col(f"`{c}`") for c in enriched.columns))
    after = enriched.agg((F.count_if(whole >= 0) + F.count_if(whole < 0)).alias("enriched_rows"))
    counts = row_count(flows).select(
        F.col("records").alias("flow_rows"), F.lit(None).cast("long").alias("enriched_rows")
    ).unionByName(after.select(F.lit(None).cast("long").alias("flow_rows"), "enriched_rows"))
    return counts.agg(
        F.max("flow_rows").alias("flow_rows"), F.max("enriched_rows").alias("enriched_rows")
    ).withColumn("no_fanout", F.col("flow_rows") == F.col("enriched_rows"))


def value_domain(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """How often each value occurs and whether it is an allowed one (NULL is not)."""
    return (
        df.groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("records"))
        .withColumn("allowed", F.coalesce(F.col("value").isin(allowed), F.lit(False)))
    )


def check_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Declared against actual columns, by position, with the table's record count."""
    have, want = df.schema.fields, expected.fields
    width = max(len(have), len(want))
    have, want = (
        [(f.name, f.dataType.simpleString()) for f in fields] + [(None, None)] * (width - len(fields))
        for fields in (have, want)
    )
    cells = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(want[i][0]).cast("string").alias("expected_column"),
            F.lit(want[i][1]).cast("string").alias("expected_type"),
            F.lit(have[i][0]).cast("string").alias("actual_column"),
            F.lit(have[i][1]).cast("string").alias("actual_type"),
            F.lit(have[i] == want[i]).alias("matches"),
        )
        for i in range(width)
    ]
    return row_count(df).select(F.explode(F.array(*cells)).alias("cell"), "records").select(
        "cell.*", "records"
    )


def partition_rows(df: DataFrame) -> DataFrame:
    """Rows each input partition delivers: how parallel the scan is."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count("*").alias("records"))
