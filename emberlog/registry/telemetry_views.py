"""The given tables seen as telemetry: logs from `events`, hosts and threats from `pages`.

Time is cut to half hours so that equality on it finds matches. It is computed from
the calendar fields of a zone-free timestamp, so the session's time zone plays no part.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from emberlog.operators.skew import fits_broadcast
from emberlog.sources.files import stamp

COMPUTERS = 10

TIME = """
    CAST(floor((datediff(ts, DATE'2024-01-01') * 86400
                + hour(ts) * 3600 + minute(ts) * 60 + second(ts)) / 1800) * 1800 AS INT)
"""
HOST = r"regexp_extract(url, r'https?://([^/]+)', 1)"

# By path and stamp of the files, so that a changed table is looked at anew.
_schemas: dict[tuple, StructType] = {}
_measured: dict[tuple, tuple[int, bool]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Its schema is looked up in the file once, not for each use."""
    path = f"{sf_dir}/{name}.parquet"
    key = path, stamp(spark, path)
    if key not in _schemas:
        _schemas[key] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[key]).parquet(path)


def _pages(spark: SparkSession, sf_dir: str) -> tuple[int, bool]:
    """How many pages there are, and whether their hosts may be broadcast; measured once."""
    key = sf_dir, stamp(spark, f"{sf_dir}/pages.parquet")
    if key not in _measured:
        pages = table(spark, sf_dir, "pages")
        _measured[key] = max(1, pages.count()), fits_broadcast(pages.select(F.expr(f"{HOST} AS host")))
    return _measured[key]


def _events(spark: SparkSession, sf_dir: str, condition: str = "true", spread: bool = False) -> DataFrame:
    """With `spread` the rows are dealt out right after the scan, whose tasks are no more than the
    row groups of the files: for work that costs much more a row than to move it."""
    events = table(spark, sf_dir, "events").where(condition)
    return (
        (events.select("event_id", "user_id", "ts").repartition("event_id") if spread else events)
        .selectExpr(
            "event_id",
            "user_id",
            f"{TIME} AS time",
            f"'C' || (user_id % {COMPUTERS}) AS computer",
            f"event_id % {_pages(spark, sf_dir)[0]} AS page_id",
        )
    )


def _with_host(events: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Add the host of the page an event goes to. The pages are measured: within the limit
    they are broadcast, beyond it they are joined by a shuffle."""
    hosts = table(spark, sf_dir, "pages").groupBy("page_id").agg(F.expr(f"min({HOST}) AS host"))
    _, small = _pages(spark, sf_dir)
    return events.join(F.broadcast(hosts) if small else hosts, "page_id", "left")


def numbered_flows(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """Flows with the `event_id` they come from."""
    events = _events(spark, sf_dir, "event_type IN ('view', 'click', 'purchase')", spread)
    return _with_host(events, spark, sf_dir).selectExpr(
        "event_id",
        "time",
        "CAST(event_id % 60 AS INT) AS duration",
        "computer AS src_computer",
        "'N' || (event_id % 1000) AS src_port",
        # Two of three flows stay between computers.
        f"IF(event_id % 3 = 0, host, 'C' || (event_id % {COMPUTERS})) AS dst_computer",
        "CAST(event_id % 1024 AS STRING) AS dst_port",
        "IF(event_id % 2 = 0, 6, 17) AS protocol",
        "CAST(event_id % 50 + 1 AS INT) AS packets_count",
        "CAST((event_id % 50 + 1) * (46 + event_id % 997) AS INT) AS bytes_count",
    )


def flows(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    return numbered_flows(spark, sf_dir, spread).drop("event_id")


def numbered_auth(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    return _events(spark, sf_dir, "event_type = 'signup'", spread).selectExpr(
        "event_id", "time", "'U' || user_id AS source_user", "computer AS source_computer"
    )


def auth(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    return numbered_auth(spark, sf_dir, spread).drop("event_id")


def proc(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    return _events(spark, sf_dir, "event_type = 'error'", spread).selectExpr(
        "time",
        "'U' || user_id || '@DOM1' AS user_domain",
        "computer",
        "'P' || (event_id % 20) AS process_name",
        "IF(event_id % 2 = 0, 'Start', 'End') AS start_end",
    )


def numbered_dns(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    return _with_host(_events(spark, sf_dir, spread=spread), spark, sf_dir).selectExpr(
        "event_id", "time", "computer AS SourceComputer", "host AS ComputerResolved"
    )


def dns(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    return numbered_dns(spark, sf_dir, spread).drop("event_id")


def feed_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed entries before flattening, with the page they come from: all pages, so hosts
    repeat with different threats. Every second entry has no tags, some have no date."""
    return (
        table(spark, sf_dir, "pages")
        .selectExpr(
            "page_id",
            "url",
            f"{HOST} AS host",
            "IF(page_id % 2 = 0, 'phishing', 'malware_download') AS threat",
            "IF(page_id % 100 <> 75,"
            " '2024-01-' || lpad(CAST(page_id % 28 + 1 AS STRING), 2, '0'), NULL) AS date_added",
            "IF(page_id % 2 = 0,"
            " array('t' || (page_id % 7), 'k' || (page_id % 3)), NULL) AS tags",
        )
    )


def iocs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flattened feed."""
    return feed_entries(spark, sf_dir).selectExpr(
        "url",
        "host",
        "threat",
        "coalesce(date_added, '') AS date_added",
        "coalesce(array_join(tags, ','), '') AS tags",
    )


def feed_documents(
    spark: SparkSession, sf_dir: str, entries: int = 1000, status: Column | None = None
) -> DataFrame:
    """Feed documents, one per `part`, of at most `entries` entries (page ids are
    unique). `status` may refer to `part`; by default every document is ok."""
    return (
        feed_entries(spark, sf_dir)
        .withColumn("part", F.floor(F.col("page_id") / entries))
        .withColumn("query_status", F.lit("ok") if status is None else status)
        .groupBy("part", "query_status")
        .agg(F.collect_list(F.struct("url", "host", "threat", "date_added", "tags")).alias("urls"))
    )
