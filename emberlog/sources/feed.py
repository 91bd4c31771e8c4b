"""Threat-intelligence feed: JSON documents ``{"query_status": …, "urls": [ … ]}``.

A document is one API answer, so reading a document in one task is bounded; many
documents are read in parallel.
"""

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlog import schemas

DEFAULT_NEWEST = 1000  # fixed value: how many entries nobody asked otherwise for
UNREADABLE = "_unreadable"
ON_BAD = ("fail", "drop", "keep")


def feed_documents(spark: SparkSession, path, one_per_line: bool = False) -> DataFrame:
    """Documents with `status`: the feed's own, `missing`, or `unreadable` for broken JSON."""
    schema = T.StructType([*schemas.FEED_DOCUMENT.fields, T.StructField(UNREADABLE, T.StringType())])
    documents = spark.read.schema(schema).json(
        path, multiLine=not one_per_line, mode="PERMISSIVE", columnNameOfCorruptRecord=UNREADABLE
    )
    status = F.when(F.col(UNREADABLE).isNotNull(), "unreadable").otherwise(F.coalesce("query_status", F.lit("missing")))
    return documents.select(status.alias("status"), "urls")


def feed_status(spark: SparkSession, path, one_per_line: bool = False) -> DataFrame:
    """How many documents came with each status."""
    return feed_documents(spark, path, one_per_line).groupBy("status").agg(F.count("*").alias("documents"))


def read_threat_feed(
    spark: SparkSession, path, on_bad: str = "fail", one_per_line: bool = False
) -> DataFrame:
    """One row per feed entry.

    A document whose status is not `ok`, a broken one included, ends the job with an
    error. With `on_bad="drop"` such documents are left out, and a warning says how
    many; `"keep"` takes the entries of every readable document and fails on broken
    ones. A file holds one document, or one on each line with `one_per_line`.
    """
    if on_bad not in ON_BAD:
        raise ValueError(f"on_bad is one of {ON_BAD}")
    documents = feed_documents(spark, path, one_per_line)
    is_ok = F.col("status") != "unreadable" if on_bad == "keep" else F.col("status") == "ok"
    if on_bad == "drop":
        dropped = documents.where(~is_ok).count()
        if dropped:
            warnings.warn(f"{dropped} feed documents without status ok were dropped", stacklevel=2)
        return flatten_feed(documents.where(is_ok))
    problem = F.concat(F.lit("feed status: "), F.col("status"))
    return flatten_feed(documents.where(F.when(is_ok, True).otherwise(F.raise_error(problem))))


def flatten_feed(documents: DataFrame) -> DataFrame:
    """Explode the entries; missing texts and tag lists become ''."""
    entry = documents.select(F.explode("urls").alias("entry"))
    texts = [
        F.coalesce(F.col(f"entry.{name}"), F.lit("")).alias(name)
        for name in ("url", "host", "threat", "date_added")
    ]
    return entry.select(*texts, joined_tags(F.col("entry.tags")).alias("tags"))


def joined_tags(tags):
    return F.coalesce(F.array_join(tags, ","), F.lit(""))


def recent_iocs(iocs: DataFrame, n: int = DEFAULT_NEWEST) -> DataFrame:
    """The `n` newest entries; ties go by URL."""
    if n < 1:
        raise ValueError("n is at least 1")
    return iocs.orderBy(F.col("date_added").desc(), "url").limit(n)
